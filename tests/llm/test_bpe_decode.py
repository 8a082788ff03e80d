import public_tokenizers

from rollcall.llm.bpe import WordBpe


def test_decoded_is_made_from_the_ids():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        own = WordBpe(file.read())
    own.known["cat"] = own.known.get("cat") or own.encoded(["the"])[0]  # a wrong id
    ids, decoded = own.encode("The cat sat")
    assert decoded == own.decode(ids) == "the</w> the</w> sat</w>"
