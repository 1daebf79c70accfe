"""Token ids of a whole corpus by a public byte-level BPE vocabulary, repeated stretches of text encoded once.

Texts are cut where a rolling hash of the last characters meets a mask, so equal stretches give equal chunks wherever they
stand. A chunk that documents share is encoded once, between its first and its last certain boundary: a place that no pre-token
of the vocabulary's pattern can span, whatever stands around it. What remains at a join, from the last such place of one chunk to
the first of a later one, is encoded anew; both ends being certain boundaries, the ids agree exactly with those of the whole text.

A chunk goes to the encoder where it is first seen and its ids stay in that task's memory, of bounded size, for all documents the
task reads. Tasks don't exchange chunks: encoding one costs less than shuffling it, so nothing is shuffled at all.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.runtime import process_cache, spread

#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    """Path of byte_bpe_50k.tiktoken: the installed package of public tokenizers, else /opt/tokenizers."""
    spec = importlib.util.find_spec("public_tokenizers")
    folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, "byte_bpe_50k.tiktoken")


@dataclass(frozen=True)
class EncodingRules:
    """window: characters under the rolling hash; mask_bits: a chunk has about 2 ** mask_bits characters; vocabulary: path on every node, None for the installed one.

    kept_chars: characters of chunks a task remembers; beyond, it forgets all and begins anew (chunks seen later are encoded again).
    """

    window: int = 16
    mask_bits: int = 9
    vocabulary: str | None = None
    kept_chars: int = 16_000_000


def encoder(path: str | None):  # noqa: ANN201
    """The encoder of this worker process, loaded once."""
    at = path or default_vocabulary()
    cache = process_cache()
    if at not in cache:
        import tiktoken

        with open(at, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        cache[at] = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return cache[at]


LETTER, DIGIT, SIGN, QUOTE, OTHER = 1, 2, 3, 4, 0


def char_classes() -> np.ndarray:
    """Class of every BMP character whose category no Unicode version since 3.2 has changed; anything else is OTHER and never bounds. White space is 5."""
    cache = process_cache()
    if "classes" in cache:
        return cache["classes"]
    out = np.zeros(0x10000, np.uint8)
    old = unicodedata.ucd_3_2_0
    for c in range(0x10000):
        ch = chr(c)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Cs", "Co", "Cc") or old.category(ch) != cat:
            continue
        out[c] = 5 if cat in ("Zs", "Zl", "Zp") else LETTER if cat[0] == "L" else DIGIT if cat[0] == "N" else SIGN
    out[ord("'")] = QUOTE
    out[[9, 10, 11, 12, 13, 0x85]] = 5
    cache["classes"] = out
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def certain_boundaries(points: np.ndarray) -> np.ndarray:
    """Offsets i at which every pre-token ends or begins, judged by points[i - 1] and points[i] alone.

    No pre-token holds a non-space before a space, a letter before a non-letter, a digit before a non-digit, or a sign other
    than the apostrophe before a letter or digit. The character before is never white space, so no look-ahead passes the cut.
    """
    k = char_classes()[np.where(points < 0x10000, points, 0)]
    a, b = k[:-1], k[1:]
    sign = (a == SIGN) | (a == QUOTE)
    known = (a != OTHER) & (b != OTHER) & (a != 5)
    differ = (b == 5) | ((a == LETTER) & (b != LETTER)) | ((a == DIGIT) & (b != DIGIT)) | (sign & (b == DIGIT)) | ((a == SIGN) & (b == LETTER))
    return np.flatnonzero(known & differ) + 1


def cut_points(points: np.ndarray, window: int, mask_bits: int) -> np.ndarray:
    """Offsets after which a chunk ends: a rolling hash of the last `window` characters has its low bits at 0."""
    n = len(points)
    if n <= window:
        return np.zeros(0, int)
    h = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    total = np.zeros(n - window + 1, np.uint64)
    for k in range(window):
        total = total * np.uint64(0x100000001B3) + h[k : k + len(total)]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    hit = (total >> np.uint64(64 - mask_bits)) == 0
    return np.flatnonzero(hit) + window


#: Characters whose hashes are in memory at a time.
SLICE = 1 << 20


def marks(points: np.ndarray, rules: EncodingRules) -> tuple[np.ndarray, np.ndarray]:
    """cut_points and certain_boundaries of any number of code points, slice by slice."""
    cuts, bounds = [np.zeros(0, int)], [np.zeros(0, int)]
    for s in range(0, len(points), SLICE):
        lo = max(0, s + 1 - rules.window)
        cuts.append(lo + cut_points(points[lo : s + SLICE], rules.window, rules.mask_bits))
        lo = max(0, s - 1)
        bounds.append(lo + certain_boundaries(points[lo : s + SLICE]))
    return np.concatenate(cuts), np.concatenate(bounds)


class Encoder:
    """Ids of texts by chunks, with the memory of one task."""

    def __init__(self, rules: EncodingRules) -> None:
        self.rules, self.encode = rules, encoder(rules.vocabulary).encode_ordinary
        self.seen: dict[str, tuple[int, int, list[int]]] = {}
        self.chars = self.encoded = self.reused = 0

    def chunk(self, text: str, first: int, last: int) -> tuple[int, int, list[int]]:
        """Where the middle of a chunk begins and ends, and its ids."""
        hit = self.seen.get(text)
        if hit is not None:
            self.reused += 1
            return hit
        if self.chars > self.rules.kept_chars:
            self.seen.clear()
            self.chars = 0
        self.encoded += 1
        self.chars += len(text)
        hit = self.seen[text] = first, last, self.encode(text[first:last])
        return hit

    def ids(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; the hashes of all are computed together."""
        points = code_points("".join(texts))
        cuts, bounds = marks(points, self.rules)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        # a cut counts if its window lies inside of one text, and if it doesn't end it
        of = np.searchsorted(ends, cuts, "left")
        cuts = cuts[(cuts - self.rules.window >= starts[of]) & (cuts < ends[of])]
        edges = np.unique(np.r_[starts, cuts, ends])
        first, last = np.searchsorted(bounds, edges[:-1], "right"), np.searchsorted(bounds, edges[1:], "left") - 1
        known = np.r_[bounds, 0]
        middle = np.where(first <= last, known[first] - edges[:-1], -1).tolist()
        until = np.where(first <= last, known[last] - edges[:-1], -1).tolist()
        place = np.searchsorted(edges, starts).tolist()
        edges = edges.tolist()
        for text, start, end, k in zip(texts, starts.tolist(), ends.tolist(), place, strict=True):
            out: list[int] = []
            open_ = 0
            at = start
            while at < end:
                to = edges[k + 1]
                if middle[k] >= 0:
                    lo, hi, ids = self.chunk(text[at - start : to - start], middle[k], until[k])
                    if at - start + lo > open_:
                        out += self.encode(text[open_ : at - start + lo])
                    out += ids
                    open_ = at - start + hi
                at, k = to, k + 1
            if open_ < len(text):
                out += self.encode(text[open_:])
            yield out


def encode_corpus(docs: DataFrame, rules: EncodingRules | None = None) -> DataFrame:
    """doc_id, ids (array of int) of every document; null and empty texts give an empty list.

    docs: doc_id, text; other columns are ignored. No special tokens are added, their names in a text are ordinary text. A
    repeated doc_id gives a row each.
    """
    r = rules or EncodingRules()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(r)
        for b in batches:
            doc_ids, texts = b.column(0), [t or "" for t in b.column(1).to_pylist()]
            lo = 0
            while lo < len(texts):
                # rows of about a slice of characters, at least one
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE):
                    size += len(texts[hi])
                    hi += 1
                flat, offsets = array("i"), [0]
                for ids in enc.ids(texts[lo:hi]):
                    flat.extend(ids)
                    offsets.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo).cast(pa.int64()), lists], schema=schema)
                lo = hi

    return spread(docs.select("doc_id", "text"), "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(docs: DataFrame, rules: EncodingRules | None = None) -> DataFrame:
    """doc_id, n_tokens of every document; 0 for null and empty texts."""
    return encode_corpus(docs, rules).select("doc_id", F.size("ids").alias("n_tokens"))
