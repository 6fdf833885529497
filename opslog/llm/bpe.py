"""BPE encoding and decoding with a contiguous rank array.

A word is a row of parts with boundaries between them.  At first every symbol
is a part; ``ranks[i]`` is the merge rank of part i with part
i + 1.  The least rank is found by a scan, its boundary is deleted, and the
ranks of the two neighbours are looked up anew, until no two adjacent parts
merge.  Scanning an array costs nothing for words of usual length; a word of
more than ``SHORT`` symbols keeps the same order of merges in a heap, so that
its cost does not grow with the square of its length.

Only the words of a text are cut out here; the file's own normalizer and
pre-tokenizer decide what a word's pieces are.  That may be done word by word:
neither of them looks past white space, and a special token, which stands for
itself before all else, holds none.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import trim

SHORT = 256  # symbols of a word whose ranks are scanned
CACHED_WORDS, CACHED_LENGTH = 120_000, 64
PLAIN, SIGNS = "\u0130", ".,;:!?"  # letters below this one are their own normal form, and lower-case to one letter
STRETCH = 1 << 20  # code points of a text that are cut into words at a time
OUT_BYTES = 8 << 20  # ids or text of a record batch handed back
NONE = 1 << 60

# Unicode white space, as the tokenizer files' regular expressions know it
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = re.compile(f"[^{SPACE}]+")
_BREAK = re.compile(f"[{SPACE}]")


class RankBPE:
    """Encoder and decoder of a BPE tokenizer file with word ends, as the tokenizers library's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"] or spec["decoder"]:
            raise ValueError("the file must hold a plain BPE without a decoder")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or _BREAK.search(t["content"]) for t in spec["added_tokens"]):
            raise ValueError("special tokens must stand for themselves")
        self.normalize, self.pieces = full.normalizer.normalize_str, full.pre_tokenizer.pre_tokenize_str
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {self.vocab[a] << 32 | self.vocab[b]: i for i, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]  # the part that a merge of this rank leaves
        self.byte = [self.vocab.get(c) for c in map(_byte_char, range(256))]
        self.last = [self.vocab.get(c + self.end) for c in map(_byte_char, range(256))]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i) for i in range(max(names) + 1)]
        self.young: dict[str, bytes] = {}  # words of late, and those before them: a full young cache becomes the old one
        self.old: dict[str, bytes] = {}

    def merge(self, parts: list[int]) -> list[int]:
        """Merges the symbols of one piece, the last of which carries the word's end, into its ids."""
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        """``parts[i]`` stands between boundaries i and i + 1; a scan finds the least of the adjacent ranks each time."""
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)  # the leftmost of equals
            del parts[i + 1], ranks[i]  # the boundary between the two
            parts[i] = p = made[least]
            if i < len(ranks):
                ranks[i] = rank(p << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | p, NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, with the ranks in a heap and the boundaries linked."""
        n, rank = len(parts), self.rank.get
        after, before, state = array("q", range(1, n + 1)), array("q", range(-1, n - 1)), array("q", bytes(8 * n))

        def push(i):  # the rank of the part at i with the next one, as both are now
            if after[i] < n and (r := rank(parts[i] << 32 | parts[after[i]], NONE)) != NONE:
                heapq.heappush(heap, (r, i, state[i]))
        heap: list[tuple[int, int, int]] = []
        for i in range(n):
            push(i)
        while heap:
            r, i, seen = heapq.heappop(heap)
            if state[i] != seen:
                continue
            j = after[i]
            parts[i], state[j], after[i] = self.made[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0:
                    state[k] += 1
                    push(k)
        return [p for p, s in zip(parts, state) if s >= 0]

    def symbols(self, data: bytes) -> list[int]:
        parts = [self.byte[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return parts

    def word(self, word: str) -> bytes:
        if word.isalpha() and max(word) < PLAIN:
            out = self.merge(self.symbols(word.lower().encode()))
        elif word[-1] in SIGNS and word[:-1].isalpha() and max(word) < PLAIN:  # a sign never joins letters
            return self.known(word[:-1]) + self.known(word[-1])
        else:
            out = []
            for i, part in enumerate(self.find_special.split(word)):
                if i % 2:
                    out.append(self.special[part])
                elif part:
                    for piece, _ in self.pieces(self.normalize(part)):
                        out += self.merge([*(self.vocab[c] for c in piece[:-1]), self.vocab[piece[-1] + self.end]])
        ids = array("I", out)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def known(self, word: str) -> bytes:
        """The ids of a word that is not in the young cache."""
        ids = self.old.get(word)
        if ids is None:
            ids = self.word(word)
        if len(word) <= CACHED_LENGTH:
            if len(self.young) >= CACHED_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; special tokens in the text are themselves, none is added."""
        out, at = [], 0
        while at < len(text):
            cut = _BREAK.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = cut.start() if cut else len(text)
            for w in _WORDS.findall(text, at, end):
                ids = self.young.get(w)
                out.append(self.known(w) if ids is None else ids)
            at = end
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids joined by one space, special tokens included, as a file without a decoder gives them."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _byte_char(b: int) -> str:
    """The printable stand-in of a byte in a byte-level vocabulary: itself, or the next free code point from 256 on."""
    if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
        return chr(b)
    return chr(256 + (b if b < 33 else b - 94 if b < 161 else 67))


@functools.cache
def rank_bpe(path: str) -> RankBPE:
    return RankBPE(path)


def _map_cells(df: DataFrame, column: str, out: str, kind: str, work, keep: bool = True) -> DataFrame:
    """``df`` with ``out`` = work(cell of ``column``), handed back in bounded batches; without ``column`` if not ``keep``."""
    names = df.columns
    kept = [f for f in df.schema if f.name != out and (keep or f.name != column)]
    at = [names.index(f.name) for f in kept]

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            cells, made, start, size = batch.column(names.index(column)), [], 0, 0
            for i in range(batch.num_rows):
                made.append(work(cells[i].as_py()))
                size += len(made[-1])
                if size > OUT_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, len(made))
                    yield pa.RecordBatch.from_arrays([*(part.column(j) for j in at), pa.array(made, pa.binary() if kind == "binary" else pa.string())],
                                                     names=[*(f.name for f in kept), out])
                    made, start, size = [], i + 1, 0
            trim()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(scan, f"{schema}, {out} {kind}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) per row: the ids of its whole text as little-endian unsigned 32-bit numbers.

    A null or empty text has no ids.  Repeated rows and null ids of documents stay rows of their own, an empty table
    gives an empty one.  Columns other than doc_id and text are ignored, whatever their names.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _map_cells(texts, "text", "ids", "binary", lambda text: rank_bpe(path).encode(text), keep=False)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (any columns, ids as ``encode_documents`` gives them, null for none) with the column decoded, in place of one of that name."""
    return _map_cells(encoded, "ids", "decoded", "string", lambda ids: rank_bpe(path).decode(ids or b""))


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, encoded and decoded again."""
    both = decode_documents(encode_documents(docs, path), path)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
