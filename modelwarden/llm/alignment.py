"""Alignment of the tokens of two tokenizers, byte by byte.

Both token sequences of a text cover the same bytes. Where an A and a B token end at one byte, the text can be cut; what
lies between two cuts is a group, and the two tokens that end there are linked.

The ends of all texts of an Arrow slice form two sorted lists. Merge-path partitioning cuts their merging into pieces of
equal work: a binary search on each diagonal says how many ends of A and of B come before it. Pieces are merged one
without another; a group that crosses from piece to piece is stitched from the last cut of one and the first of a later.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import slices, stored

#: How the byte-level file cuts a text before merging (fixed value of that vocabulary).
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, others from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(2)
def byte_level(file: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """Encoder and bytes of each id of a byte-level BPE file whose ids follow the order of merging.

    Entries marked special are left out of encoding: their strings in a text are plain text.
    """
    with open(file, encoding="utf-8") as f:
        content = json.load(f)
    special, to_byte = {t["content"] for t in content["added_tokens"] if t["special"]}, byte_characters()
    names = [b""] * (max(content["model"]["vocab"].values()) + 1)
    for entry, i in content["model"]["vocab"].items():
        names[i] = entry.encode() if entry in special else bytes(to_byte[c] for c in entry)
    ranks = {names[i]: i for entry, i in content["model"]["vocab"].items() if entry not in special}
    return tiktoken.Encoding("a", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}), names


@functools.lru_cache(2)
def piece_level(file: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """Encoder and bytes of each id of a piece file with byte fallback."""
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return model, [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


@functools.lru_cache(2)
def possible_links(a_file: str, b_file: str) -> tuple[np.ndarray, np.ndarray]:
    """All id pairs that can end together, sorted: one token's bytes end the other's.

    A token has as many ends as bytes, so there are at most as many pairs as both vocabularies have bytes, times the ids
    that spell the same bytes. This bounds every table of links, whatever the corpus.
    """
    a_names, b_names = byte_level(a_file)[1], piece_level(b_file)[1]
    by_bytes: dict[str, dict[bytes, list[int]]] = {"a": defaultdict(list), "b": defaultdict(list)}
    for side, names in (("a", a_names), ("b", b_names)):
        for i, name in enumerate(names):
            by_bytes[side][name].append(i)
    pairs = [(i, j) for i, name in enumerate(a_names) for k in range(len(name)) for j in by_bytes["b"].get(name[k:], ())]
    pairs += [(i, j) for j, name in enumerate(b_names) for k in range(1, len(name)) for i in by_bytes["a"].get(name[k:], ())]
    pairs.sort()
    table = np.array(pairs, np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]


@functools.lru_cache(2)
def _spellings(a_count: int, b_count: int) -> np.ndarray:
    """`id,` and `id|` of A, then `id,` and `id;` of B, as bytes."""
    return np.array([b"%d%s" % (i, mark) for count, marks in ((a_count, (b",", b"|")), (b_count, (b",", b";"))) for mark in marks for i in range(count)], object)


def diagonal_cuts(a_ends: np.ndarray, b_ends: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """Where `pieces` pieces of equal work begin in both lists, and their ends. Equal ends stay in one piece."""
    na, nb = len(a_ends), len(b_ends)
    diagonal = np.linspace(0, na + nb, pieces + 1).astype(np.int64)
    low, high = np.maximum(0, diagonal - nb), np.minimum(diagonal, na)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        after = a_ends[np.minimum(mid, na - 1)] <= b_ends[np.clip(diagonal - mid - 1, 0, nb - 1)]
        low, high = np.where(open_ & after, mid + 1, low), np.where(open_ & ~after, mid, high)
    i, j = low, diagonal - low
    last = np.maximum(np.where(i > 0, a_ends[np.maximum(i - 1, 0)], 0), np.where(j > 0, b_ends[np.maximum(j - 1, 0)], 0))
    return np.searchsorted(a_ends, last, side="right"), np.searchsorted(b_ends, last, side="right")


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the A and B tokens that end together, found piece by piece with about `work` ends each."""
    if not len(a_ends) or not len(b_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = diagonal_cuts(a_ends, b_ends, -(-(len(a_ends) + len(b_ends)) // work))
    found = []
    for i0, i1, j0, j1 in zip(i[:-1], i[1:], j[:-1], j[1:], strict=True):
        a, b = a_ends[i0:i1], b_ends[j0:j1]
        if len(a) and len(b):
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            hit = np.flatnonzero(b[at] == a)
            found.append((i0 + hit, j0 + at[hit]))
    # stitching: cuts of all pieces in order; a group runs from one cut to the next, wherever that was found
    return tuple(np.concatenate([f[side] for f in found]) if found else np.zeros(0, np.int64) for side in (0, 1))


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


class Aligner:
    """Tokens, groups and links of lists of texts."""

    def __init__(self, a_file: str, b_file: str, work: int):
        self.work = work
        (self.a, self.a_names), (self.b, self.b_names) = byte_level(a_file), piece_level(b_file)
        self.a_sizes, self.b_sizes = (np.array([len(n) for n in names], np.int64) for names in (self.a_names, self.b_names))
        if not self.a_sizes.all() or not self.b_sizes.all():
            raise ValueError("a token without bytes has no end of its own")
        self.spelled = _spellings(len(self.a_names), len(self.b_names))
        first, second = possible_links(a_file, b_file)
        self.keys = first * len(self.b_names) + second

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where a side's bytes are not the text after a space."""
        none, a_ids, b_ids = np.zeros(0, np.int64), [], []
        for text, second in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1), strict=True):
            if not text:
                a_ids.append(none), b_ids.append(none)
                continue
            spaced, first = " " + text, self.a.encode_to_numpy(" " + text, disallowed_special=())
            whole = spaced.encode()
            same = b"".join([self.b_names[i] for i in second]) == whole and b"".join([self.a_names[i] for i in first.tolist()]) == whole
            a_ids.append(first.astype(np.int64) if same else none), b_ids.append(np.array(second, np.int64) if same else none)
        return a_ids, b_ids

    def align(self, texts: list[str | None]) -> tuple[list[dict], np.ndarray, np.ndarray]:
        """A record for each text, and the distinct links of all with how often each is there."""
        a_ids, b_ids = self.tokens(texts)
        a_from, b_from = _starts([len(x) for x in a_ids]), _starts([len(x) for x in b_ids])
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        ia, jb = shared_ends(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), self.work)
        cut_from = np.searchsorted(ia, a_from)

        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[ia], b_last[jb] = True, True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], jb + 1])[a_group]] = a + a_last * len(self.a_names)
        order[np.arange(len(b)) + (ia + 1)[b_group]] = b + b_last * len(self.b_names) + 2 * len(self.a_names)

        count = len(self.keys)
        code = np.searchsorted(self.keys, a[ia] * len(self.b_names) + b[jb])
        links, times = np.unique(np.repeat(np.arange(len(texts)), np.diff(cut_from)) * count + code, return_counts=True)
        link_from = np.searchsorted(links, np.arange(len(texts) + 1) * count)
        links %= count
        records = []
        for k in range(len(texts)):
            na, nb = a_from[k + 1] - a_from[k], b_from[k + 1] - b_from[k]
            groups = b"".join(self.spelled[order[a_from[k] + b_from[k] : a_from[k + 1] + b_from[k + 1]]].tolist())[:-1]
            mine = slice(link_from[k], link_from[k + 1])
            records.append({"n_a": int(na), "n_b": int(nb), "n_groups": int(cut_from[k + 1] - cut_from[k]), "groups": groups, "links": links[mine], "times": times[mine]})
        return records, links, times


FOUND = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, links binary, times binary, tally boolean"


def align(docs: DataFrame, a_file: str, b_file: str, work: int = 1 << 20, keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and of links (a, b, n, best).

    A: byte-level BPE of space and text. B: pieces of the text, which adds the space. n of a link counts it over all
    documents, best says that no link of its B id has a higher n. keep_groups adds the groups as text.

    Texts are encoded once; their distinct links with counts are stored. Each task adds up its links, so that few rows
    are shuffled however often a pair occurs. The table of links is bounded by the vocabularies (`possible_links`), so
    it is broadcast.

    Cases: a null or empty text, and one that a tokenizer does not give back byte by byte (a character that it
    normalises or that stands for a space), has no tokens; null and repeated ids and equal rows are rows of their own;
    other columns are left out; an empty table gives no rows. A text is encoded whole by one task; the slice of a long
    text is that text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, total = Aligner(a_file, b_file, work), np.zeros(len(possible_links(a_file, b_file)[0]), np.int64)
        for batch in slices(batches, "text"):
            records, links, times = aligner.align(batch.column("text").to_pylist())
            total += np.bincount(links, times, len(total)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), **{c: pa.array([r[c] for r in records], pa.int64()) for c in ("n_a", "n_b", "n_groups")},
                "n_links": pa.array([int(r["times"].sum()) for r in records], pa.int64()),
                "groups_sha256": pa.array([hashlib.sha256(r["groups"]).hexdigest() if r["n_groups"] else "" for r in records]),
                "groups": pa.array([r["groups"].decode() if keep_groups else None for r in records], pa.string()),
                "links": pa.array([r["links"].astype(np.int32).tobytes() for r in records], pa.binary()),
                "times": pa.array([r["times"].astype(np.int32).tobytes() for r in records], pa.binary()), "tally": pa.array([False] * len(records)),
            })
        seen = np.flatnonzero(total)
        nothing = {c: pa.nulls(1, t) for c, t in (("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()))}
        if len(seen):
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.nulls(1, batch.column("doc_id").type), **nothing, "links": pa.array([seen.astype(np.int32).tobytes()], pa.binary()),
                "times": pa.array([total[seen].tobytes()], pa.binary()), "tally": pa.array([True]),
            })

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = possible_links(a_file, b_file)
        for batch in batches:
            for codes, times in zip(batch.column("links").to_pylist(), batch.column("times").to_pylist(), strict=True):
                codes = np.frombuffer(codes, np.int32)
                yield pa.RecordBatch.from_pydict({"code": codes, "a": a[codes], "b": b[codes], "n": np.frombuffer(times, np.int64)})

    found = stored(docs.select("doc_id", "text").mapInArrow(encoded, FOUND.format(id=kind)), "aligned", compression="zstd")
    sums = found.filter("tally").select("links", "times").mapInArrow(listed, "code int, a long, b long, n long").groupBy("code", "a", "b").agg(F.sum("n").alias("n"))
    sums = stored(sums, "links")
    best = sums.groupBy("b").agg(F.max("n").alias("most"))
    links = stored(sums.join(best, "b").select("code", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "best")
    known = links.select("code", "n", "best").toArrow()  # at most len(possible_links) rows
    size = len(possible_links(a_file, b_file)[0])
    count, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    code = np.asarray(known.column("code"))
    count[code], top[code] = np.asarray(known.column("n")), np.asarray(known.column("best"))
    tables = docs.sparkSession.sparkContext.broadcast((count, top))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, top = tables.value
        for batch in batches:
            spans = [(np.frombuffer(codes, np.int32), np.frombuffer(times, np.int32)) for codes, times in zip(batch.column("links").to_pylist(), batch.column("times").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                "n_best": pa.array([int(top[codes] @ times) for codes, times in spans], pa.int64()),
                "count_sum": pa.array([int(count[codes] @ times.astype(np.int64)) for codes, times in spans], pa.int64()),
                "groups_sha256": batch.column("groups_sha256"), "groups": batch.column("groups"),
            })

    rows = found.filter("not tally").drop("tally").mapInArrow(
        scored, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    )
    return rows if keep_groups else rows.drop("groups"), links.drop("code")
