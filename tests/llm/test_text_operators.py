"""Text operators against brute force, library results and hand-made traps."""

import json
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from modelwarden.llm import bpe, decontam, jaccard, lines, pii, sharding, substrings
from modelwarden.llm.queries import TOKENIZER

FILE = public_tokenizers.path(TOKENIZER)
ODD = [None, "", " \n ", "<|endoftext|> Hello WORLD's <|startoftext|>x", "ΑΣ ΟΔΥΣΣΕΥΣ İ ǅ ﬁ — “x”", "é\x85c​ Ⅷ ½ 😀 日本語 12345", "x" * 3000, "a."*2000 + "@b.c"]


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, spans int")


def empty(spark):
    return docs_of(spark, ["x"]).limit(0)


def test_bpe_is_the_library(spark, sf):
    tok = Tokenizer.from_file(FILE)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    df = bpe.decode(bpe.encode(docs_of(spark, texts), FILE), FILE)
    for row in df.collect():
        want = tok.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == want
        assert row.decoded == tok.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty(spark), FILE).count() == 0
    again = bpe.encode(docs_of(spark, ["a b"]).withColumnRenamed("spans", "ids"), FILE)
    assert again.first().ids == tok.encode("a b", add_special_tokens=False).ids


def test_bpe_knows_every_vocabulary_entry():
    spec = json.load(open(FILE))
    model = bpe.Bpe(spec)
    bad = [w for w, i in list(spec["model"]["vocab"].items())[512::97] if w.endswith("</w>") and len(w) > 5 and
           len(model.encode_piece(w.removesuffix("</w>"))) != 4]
    assert bad == []


def test_shards_are_even_gapless_and_reproducible(spark):
    texts = ["same"] * 300 + [None] * 50 + [f"t{i}" * (i % 40) for i in range(650)]
    df = docs_of(spark, texts).union(docs_of(spark, ["same"] * 3)).withColumnRenamed("spans", "slot")
    rows = sharding.shuffle_to_shards(df, 16, seed=1, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in df.collect())
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    key = lambda rows: sorted((r.shard, r.slot, r.doc_id) for r in rows if r.doc_id > 10)
    assert key(rows) == key(sharding.shuffle_to_shards(df.repartition(5), 16, seed=1, bucket_bytes=2000).collect())
    assert key(rows) != key(sharding.shuffle_to_shards(df, 16, seed=2, bucket_bytes=2000).collect())
    assert sharding.write_shards(sharding.shuffle_to_shards(empty(spark), 16)).count() == 0


def base_matches(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base_spans(spark):
    random.seed(3)
    texts = ODD + ["".join(random.choice("a1.-_@+ ()4é😀b2\n") for _ in range(random.choice((5, 40, 400)))) for _ in range(300)]
    texts += ["4111 1111 1111 1111 x 4111-1111-1111-1111 " * 200, "1" * 20000, "a@b.co_x@y.zz", "1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1"]
    for row in pii.base_spans(docs_of(spark, texts)).collect():
        assert [(k, s.start, s.end) for k in pii.PATTERNS for s in row[k]] == base_matches(texts[row.doc_id])
    assert pii.personal_data(empty(spark)).count() == 0


def test_pii_terms_follow_cooccurrence(spark):
    texts = [f"filler{i} common words Zebrafish writes from a.b@mail.example.com about common things" for i in range(4)]
    texts += [f"common words number{i} about common things" for i in range(60)] + ["the zebrafish alone", None, texts[0]]
    found = pii.personal_data(docs_of(spark, texts), share=0.8)
    rows = {r.doc: [(s.kind, (texts[r.doc] or "")[s.start : s.end]) for s in r.spans] for r in found.collect()}
    assert rows[0] == [("email", "a.b@mail.example.com"), ("term", "Zebrafish"), ("gone", "writes")]
    assert rows[64] == [("term", "zebrafish")] and rows[10] == [] and rows[65] == []
    clean = {r.doc_id: r.text for r in pii.sanitised(docs_of(spark, texts), found).collect()}
    assert clean[0] == "filler0 common words [TERM]  from [EMAIL] about common things" and clean[64] == "the [TERM] alone"
    assert clean[10] == texts[10] and clean[65] is None and len(clean) == len(texts)


def test_pii_counts_terms_far_from_the_value(spark):
    texts = [f"common filler{i} Zebrafish writes from a.b@mail.example.com" for i in range(3)]
    texts += [f"Zebrafish common {'padding ' * 30} filler{i} a.b@mail.example.com" for i in range(3, 9)] + [f"common padding number{i}" for i in range(60)]
    found = {r.doc: [texts[r.doc][s.start : s.end] for s in r.spans if s.kind in ("term", "gone")] for r in pii.personal_data(docs_of(spark, texts)).collect()}
    assert found[0][0] == "Zebrafish" and found[5] == ["Zebrafish"] and found[20] == []


def test_repeated_passages(spark):
    one = "Here is one long sentence that stands in many texts. And here is another one that follows it at once! "
    texts = [one + "Tail of the first.", "Own start of this text here. " + one, None, "", one.upper(), "short line\nshort line", "no repeats here at all my friend"]
    df = docs_of(spark, texts)
    found = sorted(tuple(r) for r in substrings.repeated_passages(df.union(df.filter("doc_id = 0")), 15).collect())
    assert [(f[0], texts[f[0]][f[1] : f[2]].strip().lower()) for f in found] == [(1, one.strip().lower()), (4, one.strip().lower())]
    assert all(f[5:] == (0, 0) for f in found)
    clean = {r.doc_id: r.text for r in substrings.remove_passages(df, substrings.repeated_passages(df, 15)).collect()}
    assert clean[1] == "Own start of this text here.  " and clean[0] == texts[0] and clean[2] is None
    assert substrings.repeated_passages(empty(spark)).count() == 0


def test_repeated_passages_of_short_sentences_and_lines(spark):
    cries = " ".join(f"WORD{i}!! OTHER{i}." for i in range(15))
    listed = "\n".join(f"entry {i}" for i in range(15))
    texts = [cries, cries.lower(), f"Own words. {cries} And some more. Of it.", listed, f"a heading\n{listed}\nthe end", " ".join(f"WORD{i}!! ELSE{i}." for i in range(15))]
    found = sorted(tuple(r) for r in substrings.repeated_passages(docs_of(spark, texts)).collect())
    assert [(f[0], texts[f[0]][f[1] : f[2]], f[3], f[5]) for f in found] == [(1, cries.lower(), 30, 0), (2, cries, 30, 0), (4, listed, 30, 3)]
    for text in [*texts, "one", "a b. c. d e."]:
        held = {w for _, _, first, n, _ in substrings.units_of(text, 4) for w in range(first, first + n)}
        assert held == set(range(len(text.split())))


def linked_groups(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index, sets = {}, dict(rows)
    for i, found in rows:
        both = Counter(j for g in found for j in index.get(g, ()))
        for j, n in both.items():
            if 100 * n >= 80 * (len(found) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in found:
            index.setdefault(g, []).append(i)
    return {i: find(i) for i, _ in rows}


def shingles(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


@pytest.mark.parametrize("options", [{}, {"most": 20, "order_bound": 50, "large": 8, "chunk": 16}])
def test_jaccard_groups_are_exact(spark, options):
    random.seed(5)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(w if random.random() > p else f"z{random.randrange(99)}" for w in base) for _ in range(150) for p in [random.choice((0, 0.01, 0.03, 0.05))]]
    texts += [" ".join(random.choice("abc") for _ in range(random.choice((1, 2, 4, 5, 6, 8, 12)))) for _ in range(250)]
    texts += [None, "", "  \n", "one", "ONE", "É", "é", "x " * 3000]
    want = linked_groups([(i, shingles(t)) for i, t in enumerate(texts)])
    got = {r.doc: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(spark, texts), **options).collect()}
    assert got == {i: (len(shingles(t)), want[i]) for i, t in enumerate(texts)}


def test_jaccard_edges(spark):
    assert jaccard.similar_groups(empty(spark)).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (4, None), (None, "q r")], "doc_id long, text string")
    assert jaccard.keep_one(rows).count() == 5  # repeated rows of the kept id, the null id of that group, and the rest


def test_near_copy_stage_leaves_one_row_of_each_group(spark):
    from corpus_pipeline import near_copy_stage

    copy, near = "a b c d e", " ".join(f"w{i}" for i in range(60))
    rows = [(None, copy, 1), (3, copy, 2), (3, copy, 1), (5, near, 1), (5, near + " end", 1), (6, near, 1), (4, None, 1), (4, None, 1), (None, "q r", 1),
            (None, "q r", 1), (None, "s t", 1), (3, "u v", 1), (7, "u v", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    left = sorted(map(tuple, near_copy_stage(spark, df, "").collect()), key=str)
    fives = [r for r in left if r[0] == 5]
    assert len(fives) == 1 and fives[0] in rows
    assert [r for r in left if r[0] != 5] == sorted([(3, copy, 1), (3, "u v", 1), (4, None, 1), (4, None, 1), (None, "q r", 1), (None, "s t", 1)], key=str)
    assert near_copy_stage(spark, df.limit(0), "").count() == 0


def test_line_spread(spark):
    texts = ["Share  This page NOW\nbody %d" % i for i in range(12)] + ["rare line here\nx", None, ""]
    rows = [(i, t, f"s{i % 9}", 7) for i, t in enumerate(texts)] + [(0, texts[0], "s0", 7), (99, "rare line here", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines int")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(df, 9).filter("text is not null").collect())
    assert got[:2] == [(0, texts[0], 2, 0)] * 2
    assert all(g == (i, f"body {i}", 2, 1) for i, g in enumerate(got[2:13], 1))
    assert got[13:] == [(12, texts[12], 2, 0), (14, "", 1, 0), (99, "rare line here", 1, 0)]
    assert lines.dedup_lines(df.limit(0)).count() == 0
    assert lines.dedup_lines(df, 10).agg({"n_removed": "sum"}).first()[0] == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(s, "line number %d here" % n, f"site{s}") for n in range(6, 12) for s in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide = lines.spread_lines(lines.line_table(df), 9)
    assert wide.count() == 3


def test_contamination(spark):
    words = [f"Wört{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "tiny item"), (3, None), (4, "--"), (2, "tiny item")], "item_id long, text string")
    texts = [" ".join(words).replace("W", "w"), "x " * 300 + "; ".join(words[3:16]), " ".join(words[:12]), "a tiny ITEM", None, "", "WÖRT0", "tiny " * 5 + "item"]
    got = {r.doc: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontam.contamination(docs_of(spark, texts), items).collect()}
    assert got == {0: (20, 20, ["1"], True), 1: (313, 13, ["1"], False), 2: (12, 0, [], False), 3: (3, 2, ["2"], True), 4: (0, 0, [], False),
                   5: (0, 0, [], False), 6: (1, 0, [], False), 7: (6, 2, ["2"], True)}
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs_of(spark, texts), items).collect()) == [1, 2, 4, 5, 6]
    assert decontam.contamination(empty(spark), items).count() == 0
    assert decontam.contamination(docs_of(spark, texts), items.limit(0)).filter("contaminated").count() == 0


def test_contamination_by_items_of_one_id_and_of_none(spark):
    one, two, three, four = ([f"{c}{i}" for i in range(15)] for c in ("red", "blue", "green", "grey"))
    items = spark.createDataFrame([(1, " ".join(one)), (1, " ".join(two)), (None, " ".join(three)), (None, " ".join(four)), (2, " ".join(two))], "item_id long, text string")
    texts = [" ".join(w) for w in (one, two, three, four, one[:12])]
    got = {r.doc: (r.n_hit, r["items"], r.contaminated) for r in decontam.contamination(docs_of(spark, texts), items).collect()}
    assert got == {0: (15, ["1"], True), 1: (15, ["1", "2"], True), 2: (15, [], True), 3: (15, [], True), 4: (0, [], False)}


def test_proximity(spark):
    words = [f"word{i}" for i in range(26)]
    items = spark.createDataFrame([(1, " ".join(words)), (None, "five words make one item"), (2, "single")], "item_id long, text string")
    changed = [["other" if i == j or i == j + 13 else w for i, w in enumerate(words)] for j in range(13)]
    texts = [" ".join(c) for c in changed] + [" ".join(words[1:]), " ".join(w + " more" if i % 13 == 6 else w for i, w in enumerate(words))]
    texts += [" ".join(words), "x five words make one thing", "a SINGLE b", " ".join(words[::2]), " ".join(reversed(words)), None, ""]
    df = docs_of(spark, texts)
    got = {r.doc: r["items"] for r in decontam.proximity(df, items).collect()}
    assert got == {i: ["1"] for i in range(16)} | {16: [], 17: ["2"]}
    assert sorted(r.doc for r in decontam.contamination(df, items).filter("contaminated").collect()) == [13, 14, 15, 17]
    assert decontam.proximity(empty(spark), items).count() == 0 and decontam.proximity(df, items.limit(0)).count() == 0


def test_crc_of_ids_splits_labels(spark):
    from modelwarden.llm.features import in_training

    rows = spark.range(50).select("id", in_training("id").alias("t")).collect()
    assert all(r.t == (zlib.crc32(str(r.id).encode()) % 5 != 0) for r in rows)
