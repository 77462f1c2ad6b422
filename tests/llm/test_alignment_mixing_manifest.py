"""Operators 11 to 13 against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from modelwarden.llm import alignment, manifest, mixing
from modelwarden.llm.common import positions

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "▁", "a▁b", "\x00", "it's <|endoftext|> <s> </s> <unk> <0x41>", "naïve café", "𝔘𝔫𝔦 ", "\n\n \t x", "é́", "x" * 3000, "  two  spaces  ", "ﬁ ½ Ⅳ"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_alignment(texts):
    a_model, b_model = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a_model.encode_special_tokens = True
    bytes_of = alignment.byte_characters()
    rows, count = [], Counter()
    for text in texts:
        a, b = [], []
        if text:
            whole = (" " + text).encode()
            coded = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(bytes_of[c] for c in a_model.id_to_token(i))) for i in coded.ids]
            for i in b_model.encode(text):
                piece = b_model.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a, b = [], []
        ends = [{sum(len(y) for _, y in side[: k + 1]): k for k in range(len(side))} for side in (a, b)]
        groups, links, i0, j0 = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][end], ends[1][end]
            groups.append(",".join(str(x) for x, _ in a[i0 : i + 1]) + "|" + ",".join(str(x) for x, _ in b[j0 : j + 1]))
            links.append((a[i][0], b[j][0]))
            i0, j0 = i + 1, j + 1
        count.update(links)
        rows.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (na, nb, len(g), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), sha(";".join(g)) if g else "") for na, nb, g, ls in rows
    ], count


@pytest.mark.parametrize("work", [3, 1 << 20])
def test_alignment_equals_plain_python(spark, sf, work):
    real = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(40).collect()]
    rng = random.Random(7)
    mixed = ["".join(rng.choice(["a", "B ", "é", "\n", "12", "'s ", "ß", " ", "日", "!"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts = ODD + ["same words here"] * 20 + real + mixed
    docs = spark.createDataFrame([(None if i == 3 else i % 70, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string").repartition(5)
    rows, links = alignment.align(docs, A_FILE, B_FILE, work=work)
    expected, count = plain_alignment(texts)
    got = sorted(map(tuple, rows.collect()), key=str)
    assert got == sorted([(None if i == 3 else i % 70, *r) for i, r in enumerate(expected)], key=str)
    assert {(r.a, r.b): r.n for r in links.collect()} == count


def test_alignment_of_an_empty_table(spark):
    rows, links = alignment.align(spark.createDataFrame([], "doc_id int, text string"), A_FILE, B_FILE, keep_groups=True)
    assert rows.count() == 0 and links.count() == 0 and "groups" in rows.columns


def test_byte_level_ids_are_those_of_the_tokenizers_library():
    model, ours = Tokenizer.from_file(A_FILE), alignment.byte_level(A_FILE)[0]
    model.encode_special_tokens = True
    points = [chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}1 {c}{c}b{c} {c}1{c}" for c in points] + [t or "" for t in ODD]
    assert all(e.ids == ours.encode_ordinary(t) for e, t in zip(model.encode_batch(texts, add_special_tokens=False), texts, strict=True))


def test_pieces_of_equal_work_find_every_shared_end():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (np.unique(rng.integers(1, 400, rng.integers(1, 300))) for _ in range(2))
        i, j = alignment.diagonal_cuts(a, b, 9)
        assert max(np.diff(i + j)) <= (len(a) + len(b)) // 9 + 3
        ia, jb = alignment.shared_ends(a, b, int(rng.integers(1, 50)))
        assert (a[ia] == b[jb]).all() and a[ia].tolist() == sorted(set(a) & set(b))


def plain_targets(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left, w = total - limit * sum(sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        target = {s: limit * sizes[s] if s in full else left * weight[s] / w for s in names}
        above = {s for s in names if target[s] > limit * sizes[s]}
        if not above:
            return target
        full |= above


def mix_fixture(spark):
    rng, rows = random.Random(5), []
    for i in range(1500):
        source = ["hot"] * 10 + ["a", "b", "Z", "é", None]
        n = rng.choice([0, 1, 3, 20, 20, 150, 900])
        rows.append((i // 2, " ".join(["w"] * n) if i % 40 else None, rng.choice(source), n))
    rows += [(7, "same text of five words", "hot", 0)] * 800 + [(None, "\tx\x0by z ", "one", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(6)


def test_mix_meets_targets_and_repeats(spark):
    rows, docs = mix_fixture(spark)
    mixed = mixing.mix(docs)
    first = mixed.collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r[1] or "")])
    target, taken = plain_targets(dict(sizes)), defaultdict(int)
    assert len(first) == len(rows) and sum(r["size"] for r in first) == sum(sizes.values())
    for r in first:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"] and abs(r.copies - r.rate) < 1
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(2, 0.01 * t) or sizes[s] < 10
    full = [r.copies for r in first if r.source is not None and r.target == 2 * r.source_size and r["size"]]
    assert full and set(full) == {2}


def test_rates_are_exponential_tilts(spark):
    _, docs = mix_fixture(spark)
    by_size = defaultdict(dict)
    for r in mixing.mix(docs).filter("size > 0").select("source", "size", "rate").distinct().collect():
        by_size[r.source][r["size"]] = r.rate
    for rates in by_size.values():
        tilt = {round(np.log(w) / x, 6) for x, w in rates.items() if 1e-3 < w < 2}
        assert max(tilt, default=0) - min(tilt, default=0) < 1e-4


def test_mix_of_odd_tables(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], kind)).count() == 0
    none = mixing.mix(spark.createDataFrame([(1, None, "a"), (1, "", None)], kind)).collect()
    assert [r.taken for r in none] == [0, 0]
    one = mixing.mix(spark.createDataFrame([(i, "two words", "a") for i in range(100)], kind)).collect()
    assert sum(r.taken for r in one) == 300 and {r.copies for r in one} == {1, 2}


def plain_manifest(rows, changed_of):
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(hs):
        levels = [hs]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def steps(levels, k):
        return [(k >> n & 1, level[(k >> n) ^ 1] if (k >> n) ^ 1 < len(level) else "") for n, level in enumerate(levels[:-1])]

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    mine = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    low = {g: tree([leaf(r) for r in mine[g]]) for g in langs}
    high = tree([low[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for k, r in enumerate(mine[g]):
            path = steps(low[g], k) + steps(high, at)
            h = leaf(changed_of(r))
            for own, s in path:
                h = sha(s + h if own else h + s)
            out.append((r[0], leaf(r), low[g][-1][0], high[-1][0], sha("".join(s for _, s in path)), h, h == high[-1][0]))
    return sorted(out, key=str)


def tampered(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
    return (*r[:3], r[3] + 1, r[4]) if hit else r


@pytest.mark.parametrize("n", [1, 3, 17, 300])
def test_manifest_equals_plain_python(spark, tmp_path, n):
    from modelwarden.llm.queries import op13_merkle_manifest

    rng = random.Random(n)
    rows = [(rng.choice([None, *range(n)]), rng.choice(["s", None, "é"]), rng.choice(["en"] * 8 + [None, "de", "", "é"]), rng.choice([None, 5]), rng.choice(["", None, "t" * 5000, "x"])) for _ in range(n)]
    rows += rows[: n // 3]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == plain_manifest(rows, tampered)


def test_manifest_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest.manifest(docs, F.col("n_chars")).count() == 0


def test_positions_count_from_zero_in_every_group(spark):
    rows = [(None if i % 9 == 0 else i % 3, i % 50, i) for i in range(700)] + [(1, 7, 0)] * 500
    df = spark.createDataFrame(rows, "g int, v int, x int").repartition(7)
    got = defaultdict(list)
    for r in positions(df, ["g"], [F.col("v").desc()]).collect():
        got[r.g].append((r.pos, r.v, r.group_size))
    assert sum(map(len, got.values())) == len(rows)
    for found in got.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found))) and {s for _, _, s in found} == {len(found)}
        assert [v for _, v, _ in found] == sorted((v for _, v, _ in found), reverse=True)
