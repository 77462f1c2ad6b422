"""BPE encoding and decoding with a public tokenizer file, by dynamic programming over prefixes.

The text is cut into pieces as the file says (special tokens first, then NFC, lower case, the piece pattern). In a
piece, every prefix has exactly one possible last token: among the vocabulary entries that end there (found in one
walk over the piece with an automaton of all entries), the one that is compatible with the last token of the prefix it
follows. Two tokens are compatible when undoing their merges in order of age never shows an older merge across the
border. Back-pointers give the ids. No merge queue runs over the text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from modelwarden.llm.common import KEPT, released, slices

END = "\ue000"
RECENT = re.compile(r"[^\x00-\u052f\u2000-\u206f]")
#: What `str.split` takes for a blank and the files do not.
NO_BLANKS = "\x1c\x1d\x1e\x1f"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte value: itself where printable, else the next free code point from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Bpe:
    """A vocabulary in which ids grow with the age of merges, and caches of bounded size."""

    def __init__(self, spec: dict, cache: int = 160_000) -> None:
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.cache = cache
        self.own = {k: v for k, v in spec.items() if k != "model"} | {"model": {**model, "vocab": {}, "merges": []}, "added_tokens": []}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"), regex.V1).findall
        self.table = dict(enumerate(byte_alphabet()))
        size = max(max(vocab.values()), max(self.special.values(), default=0)) + 1
        self.left, self.right = list(range(size)), list(range(size))
        self.pair: dict[int, int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            token = vocab[a.removesuffix(suffix) + b if a.endswith(suffix) and suffix else a + b]
            self.left[token], self.right[token] = vocab[a], vocab[b]
            self.pair[vocab[a] << 20 | vocab[b]] = token
        self.automaton = ahocorasick.Automaton()
        for word, token in vocab.items():
            closed = bool(suffix) and word.endswith(suffix) and word != suffix
            body = word.removesuffix(suffix) if closed else word
            self.automaton.add_word(body + END if closed else body, (token, len(body), closed))
        self.automaton.make_automaton()

    @cached_property
    def cutter(self) -> tokenizers.Tokenizer:
        """The library's normaliser and cutter of the file, without its vocabulary."""
        return tokenizers.Tokenizer.from_str(json.dumps(self.own))

    def compatible(self, a: int, b: int) -> bool:
        """True when token b can directly follow token a in an encoding."""
        # Tokens below `bar` may still be formed across the border at this stage of undoing.
        bar = 1 << 30
        while True:
            joined = self.pair.get(a << 20 | b)
            if joined is not None and joined < bar:
                return False
            a_parts, b_parts = self.right[a] != a, self.left[b] != b
            if not a_parts and not b_parts:
                return True
            if a_parts and (a > b or not b_parts):
                bar, a = a, self.right[a]
            else:
                bar, b = b + 1, self.left[b]

    def encode_piece(self, text: str) -> bytes:
        """Ids of one piece, given in the byte alphabet, as int32 bytes."""
        n = len(text)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        fits = self.fits
        if len(fits) > 200_000:
            fits.clear()
        known = fits.get
        for end, (token, size, closed) in self.automaton.iter(text + END):
            if closed:
                stop = n
            else:
                stop = end + 1
                if stop >= n:  # the end mark's own place, or a token that would have to close the piece
                    continue
            if last[stop] >= 0:
                continue
            start = stop - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 20 | token
                fit = known(key)
                if fit is None:
                    fit = fits[key] = self.compatible(before, token)
                if not fit:
                    continue
            last[stop], back[stop] = token, start
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        ids.reverse()
        return array("i", ids).tobytes()

    def words(self, text: str) -> list[str]:
        """Parts of a text without special tokens whose ids do not depend on each other: what stands between blanks, in
        which no piece lies across two parts; single pieces where `split` and the file differ in what a blank is. Pieces
        from the library's own cutter are marked with END."""
        if not text.isascii():
            if RECENT.search(text):  # classes of such code points depend on the Unicode version of the library
                found = self.cutter.pre_tokenizer.pre_tokenize_str(self.cutter.normalizer.normalize_str(text))
                return [END + piece for piece, _ in found]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return self.pieces(text) if any(c in text for c in NO_BLANKS) else text.split()

    def piece(self, text: str) -> bytes:
        """Ids of one piece, from the cache where they are known."""
        code = self.young.get(text) or self.old.get(text)
        if code is None:
            if text.isascii() and text.isprintable():
                shown = text  # printable ASCII stands for itself
            elif text[0] == END:
                shown = text[1:]
            else:
                shown = "".join(map(self.table.__getitem__, text.encode("utf-8")))
            code = self.encode_piece(shown)
        if len(text) <= 64:
            self.young[text] = code
        return code

    def segment(self, text: str) -> list[bytes]:
        words = self.words(text)
        young, old = self.young, self.old
        codes = list(map(young.get, words))
        for at in [k for k, code in enumerate(codes) if code is None]:
            word = words[at]
            if word.isalpha() or word[0] == END:
                codes[at] = self.piece(word)
                continue
            code = young.get(word) or old.get(word)  # the word may stand in the text twice
            if code is None:
                pieces = self.pieces(word)
                parts = list(map(young.get, pieces))
                if None in parts:  # as yet too rare to be kept next to its pieces
                    codes[at] = b"".join([part or self.piece(piece) for part, piece in zip(parts, pieces)])
                    continue
                code = b"".join(parts)
            if len(word) <= 64:
                young[word] = code
            codes[at] = code
        if len(young) > self.cache:
            self.young, self.old = {}, young
        return codes

    def encode(self, text: str) -> bytes:
        if self.special_pattern is None or "<" not in text:
            return b"".join(self.segment(text))
        out: list[bytes] = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.int32).tobytes())
            else:
                out += self.segment(part)
        return b"".join(out)


def token_names(spec: dict) -> list[str]:
    """The name of each token by id; empty where an id is unused."""
    known = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    names = [""] * (max(known.values(), default=-1) + 1)
    for word, token in known.items():
        names[token] = word
    return names


def _model(text: str) -> Bpe:
    """One model per worker and file; the first use in a worker builds it."""
    key = ("bpe", hash(text))
    if key not in KEPT:
        KEPT.clear()
        KEPT[key] = Bpe(json.loads(text))
    return KEPT[key]


def _with(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*(f for f in schema if f.name not in dict(fields)), *(T.StructField(*f) for f in fields)])


def encode(docs: DataFrame, file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids` (array of int) with the token ids of `text`; a column of that name is replaced.

    Null and empty text give an empty array. Rows are independent: no shuffle, repeated rows stay repeated. Special
    tokens written out in a text become their ids. The tokenizer file (of fixed size) is broadcast.
    """
    with open(file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(spec.value)
        for batch in slices(batches, text, 1_000_000):
            codes = [model.encode(t.as_py() or "") for t in batch.column(text)]
            ends = np.zeros(len(codes) + 1, np.int32)
            ends[1:] = np.cumsum([len(c) // 4 for c in codes])
            values = pa.array(np.frombuffer(b"".join(codes), np.int32))
            yield _replaced(batch, ids, pa.ListArray.from_arrays(pa.array(ends), values))

    return docs.mapInArrow(released(run, keep=True), _with(docs.schema, (ids, T.ArrayType(T.IntegerType()))))


def decode(docs: DataFrame, file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds `text` with the token names of `ids` joined by one space; null and empty arrays give an empty string.

    The file has no decoder, so names stay as they are; unknown ids are left out. Only the names go to the executors.
    """
    with open(file, encoding="utf-8") as f:
        known = docs.sparkSession.sparkContext.broadcast(token_names(json.load(f)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(known.value, pa.string())
        for batch in id_slices(batches, ids):
            yield _replaced(batch, text, joined_names(batch.column(ids), names))

    return docs.mapInArrow(released(run, keep=True), _with(docs.schema, (text, T.StringType())))


def joined_names(ids: pa.ListArray, names: pa.StringArray) -> pa.StringArray:
    """The names of each row's ids joined by one space; null rows are empty, ids without a name are left out."""
    offsets, flat = row_ids(ids)
    has_name = np.append(np.asarray(pc.binary_length(names)) > 0, False)
    at = np.asarray(pc.fill_null(flat, -1)).astype(np.int64)
    at[(at < 0) | (at >= len(names))] = len(names)
    shown = has_name[at]
    ends = np.concatenate([[0], np.cumsum(shown)])[offsets].astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), names.take(pa.array(at[shown]))), " ")


def row_ids(ids: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Offsets (from 0) and ids of all rows, one after the other; a null row has none."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(ids), 0)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), ids.flatten()


def id_slices(batches: Iterator[pa.RecordBatch], ids: str, most: int = 250_000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into slices of about `most` ids (one row at least)."""
    for batch in batches:
        ends, start = row_ids(batch.column(ids))[0], 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, f in enumerate(batch.schema) if f.name != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), values], [*(batch.schema.field(i).name for i in kept), name])
