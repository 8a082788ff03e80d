"""BPE with word ends: encoding by forced boundaries, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rollcall.llm.common import text_batches

#: Pieces, of at most SHORT characters, that a worker keeps the tokens of.
CACHE, SHORT = 100_000, 48
#: Symbols up to which fragments are merged side by side; longer ones are merged one by one with a heap.
BESIDE = 64
#: Unicode White_Space, which the tokenizer file's \s stands for.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Texts with a character outside these ranges, where Unicode has long been settled, are normalised and cut by the library itself.
UNSETTLED = re.compile(r"[^\x00-\u052f\u2000-\u206f\u20a0-\u20b0\u3000-\u3020\u3041-\u3094\u30a1-\u30fe\u4e00-\u9fa5\uac00-\ud7a3]")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def letter_class(kind: str) -> str:
    """The characters of the basic plane whose Unicode category starts with kind, as the inside of a character class."""
    member = np.array([unicodedata.category(chr(c))[0] == kind for c in range(1 << 16)] + [False])
    edges = np.flatnonzero(np.diff(np.r_[False, member]))
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in edges.reshape(-1, 2))


class WordBpe:
    """The vocabulary, merges and fixed pre-processing of a word-end BPE file without decoder, given as its JSON text."""

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        spec = json.loads(spec)
        model = spec["model"]
        if spec.get("decoder") or not model.get("end_of_word_suffix"):
            raise ValueError("only word-end BPE files without decoder are known")
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [named.get(i, "") for i in range(max(named) + 1)]
        letters = byte_letters()
        self.bytes = {c: b for b, c in letters.items()}
        word, digit = letter_class("L"), letter_class("N")
        self.piece = re.compile(rf"[{word}]+|'s|'t|'re|'ve|'m|'ll|'d|[{digit}]|[^{SPACE}{word}{digit}]+")
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # symbols: bytes, and from 256 on bytes that end a piece
        self.first_ids = np.array([self.vocab[letters[b] + e] for e in ("", self.end) for b in range(256)], np.int64)
        self.inside = {pair for token in self.vocab for s in [self._symbols(token)] for pair in zip(s, s[1:])}
        number = {c: b for c, b in self.bytes.items()} | {c + self.end: 256 + b for c, b in self.bytes.items()}
        self.meets = np.zeros((512, 512), bool)
        for x, y in self.inside:
            self.meets[number[x], number[y]] = True
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.vocab[x] << 32 | self.vocab[y] for x, y in merges], np.int64)
        self.made = np.array([self.vocab[x.removesuffix(self.end) + y if x.endswith(self.end) else x + y] for x, y in merges], np.int64)
        self.ranks = dict(zip(keys.tolist(), range(len(keys))))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.none = len(keys)
        self.known: dict[str, bytes] = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}

    def _symbols(self, token: str) -> list[str]:
        """A token's letters; the last one carries the word end, if there is one."""
        if token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def cut(self, text: str) -> list[str]:
        """The normalised text's pieces."""
        if UNSETTLED.search(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.bytes.__getitem__, p)).decode() for p, _ in pieces]
        # lower-casing goes by single characters, so a final sigma is like any other
        return self.piece.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; special tokens in it are pieces of their own."""
        if not self.splitter or not any(s in text for s in self.special):
            return self.cut(text)
        return [p for part in self.splitter.split(text) for p in ([part] if part in self.special else self.cut(part))]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], self.none)

    def _merged_long(self, ids: list[int]) -> list[int]:
        """One fragment: joins the adjacent pair of the lowest rank, the leftmost of several, until no pair has one. A heap over a linked list."""
        after, before = [*range(1, len(ids) + 1)], [*range(-1, len(ids) - 1)]
        rank = lambda i: self.ranks.get(ids[i] << 32 | ids[after[i]]) if i >= 0 and after[i] < len(ids) else None
        heap = [(r, i) for i in range(len(ids)) if (r := rank(i)) is not None]
        heapify(heap)
        made = self.made.tolist()
        while heap:
            r, i = heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue  # what stood here has changed since
            gone = after[i]
            ids[i], ids[gone], after[i] = made[r], -1, after[gone]
            if after[i] < len(ids):
                before[after[i]] = i
            for x in (before[i], i):
                if (r := rank(x)) is not None:
                    heappush(heap, (r, x))
        return [x for x in ids if x >= 0]

    def _merged(self, ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many fragments side by side: ids and the (ascending) fragment of each. Every step makes one merge in each fragment that has one left."""
        done_ids, done_of = [], []
        rank = np.full(len(ids), self.none)
        rank[:-1] = np.where(of[1:] == of[:-1], self._pair_ranks(ids[:-1], ids[1:]), self.none)
        while len(ids):
            start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            size = np.diff(np.r_[start, len(ids)])
            least = np.minimum.reduceat(rank, start)
            going = np.repeat(least < self.none, size)
            done_ids.append(ids[~going])
            done_of.append(of[~going])
            best = np.repeat(least, size)[going]
            ids, of, rank = ids[going], of[going], rank[going]
            if not len(ids):
                break
            at = np.flatnonzero(rank == best)
            at = at[np.r_[True, of[at[1:]] != of[at[:-1]]]]
            ids[at] = self.made[rank[at]]
            left = np.ones(len(ids), bool)
            left[at + 1] = False
            ids, of, rank = ids[left], of[left], rank[left]
            at = at - np.arange(len(at))  # every fragment before has lost one symbol
            for x in (at[at > 0] - 1, at):
                y = np.minimum(x + 1, len(ids) - 1)
                rank[x] = np.where((x < y) & (of[x] == of[y]), self._pair_ranks(ids[x], ids[y]), self.none)
        ids, of = np.concatenate([*done_ids, ids]), np.concatenate([*done_of, of])
        order = np.argsort(of, kind="stable")
        return ids[order], of[order]

    def encoded(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers.

        A piece is cut wherever two bytes meet that meet in no vocabulary token; the fragments are encoded alone, and what
        comes of them is joined.
        """
        texts = [p.encode() for p in pieces]
        if not texts:
            return []
        ends = np.cumsum([len(t) for t in texts])
        symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        symbols[ends - 1] += 256
        cut = np.ones(len(symbols) + 1, bool)
        cut[1:-1] = ~self.meets[symbols[:-1], symbols[1:]]
        cut[ends] = True
        bounds = np.flatnonzero(cut)
        size = np.diff(bounds)
        ids, of = self.first_ids[symbols], np.repeat(np.arange(len(size)), size)
        long = size > BESIDE
        one_by_one = [np.array(self._merged_long(ids[bounds[f] : bounds[f + 1]].tolist())) for f in np.flatnonzero(long)]
        beside = ~long[of]
        merged, at = self._merged(ids[beside], of[beside])
        if one_by_one:
            merged, at = np.concatenate([merged, *one_by_one]), np.concatenate([at, np.repeat(np.flatnonzero(long), [len(x) for x in one_by_one])])
            order = np.argsort(at, kind="stable")
            merged, at = merged[order], at[order]
        # the tokens of a piece are those of the fragments that end no later than it does
        stop = 4 * np.searchsorted(at, np.searchsorted(bounds, ends), side="left")
        found = merged.astype("<u4").tobytes()
        return [found[x:y] for x, y in zip([0, *stop.tolist()], stop.tolist())]

    def all_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Pieces that are not known yet are encoded together; when there are too many, those of the last texts stay known."""
        cuts, known = [self.pieces(t) for t in texts], self.known
        new = list(set(chain.from_iterable(cuts)).difference(known))
        known.update(zip(new, self.encoded(new)))
        found = [b"".join(map(known.__getitem__, c)) for c in cuts]
        for p in new:
            if len(p) > SHORT:
                del known[p]
        if len(known) > CACHE:
            last = {p for c in cuts for p in c if len(p) <= SHORT}
            self.known = {p: known[p] for p in chain(self.special, last)}
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids, and the text decoded from them."""
        ids = self.all_ids([text])[0]
        return ids, self.decode(ids)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids joined by spaces, as for a file without decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_built: dict[str, WordBpe] = {}


def _model(spec: str) -> WordBpe:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _built:
        _built[key] = WordBpe(spec)
    return _built[key]


SCHEMA = [("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("ids_sha256", T.StringType()), ("decoded", T.StringType()), ("decoded_sha256", T.StringType())]


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """docs with the columns in outputs (of n_tokens, ids, ids_sha256, decoded, decoded_sha256) added; other columns stay, in order.

    tokenizer is the path of a word-end BPE file; the driver reads it (some 2 MB) and broadcasts its text.
    Null and empty texts have no tokens, empty bytes and an empty decoded text. An output replaces a column of
    docs with its name. decoded is made from the ids. No shuffle; a worker keeps the tokens of at most CACHE short pieces.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [f for f in docs.schema.fields if f.name not in outputs]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("__rc_text"))
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in SCHEMA if n in outputs]])
    wanted = [n for n, _ in SCHEMA if n in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(spec.value)
        decodes = "decoded" in wanted or "decoded_sha256" in wanted
        for batch in text_batches(batches, len(kept)):
            made: dict[str, list] = {n: [] for n in wanted}
            for ids in model.all_ids([t or "" for t in batch.column(len(kept)).to_pylist()]):
                decoded = model.decode(ids) if decodes else ""
                for n in wanted:
                    made[n].append(
                        len(ids) // 4 if n == "n_tokens" else ids if n == "ids" else hashlib.sha256(ids).hexdigest() if n == "ids_sha256"
                        else decoded if n == "decoded" else hashlib.sha256(decoded.encode()).hexdigest()
                    )
            kinds = {"n_tokens": pa.int64(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *[pa.array(made[n], kinds.get(n, pa.string())) for n in wanted]], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
