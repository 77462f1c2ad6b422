"""One query for each operator of this folder over its whole table, with SQL twins where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwarden.llm import alignment, bpe, decontam, embeddings, jaccard, lines, manifest, mixing, pii, quality, sharding, substrings, toxicity

TOKENIZER = "word_bpe_49k.json"
SHARDS = 16
SITES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path(TOKENIZER)
    docs = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), file).drop("text"), file)
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = sharding.write_shards(sharding.shuffle_to_shards(docs, SHARDS, seed=2))
    return shards.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["order"] < len(pii.PATTERNS))
    return found.select(
        F.col("doc").alias("doc_id"), *[count(k) for k in pii.PATTERNS], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"),
        count("term"), count("gone"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.dedup_lines(table(spark, sf_dir, "documents"), SITES)
    return docs.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("text_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.proximity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "n_windows", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, limit=2.0, weights=(5, 2, 1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering adds 1 to n_chars of every row whose id has a CRC-32 that 7 divides."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    changed = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1).otherwise(F.col("n_chars").cast("decimal(38,0)"))
    proved = manifest.manifest(table(spark, sf_dir, "documents"), changed)
    found = proved.withColumn("folded_root", manifest.folded(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op7_proximity": op7_proximity,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_mixing": op12_mixing,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LINES = rf"""
parts as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
cut as (select doc_id, source, unnest(ls) as line, unnest(range(len(ls))) as pos from parts),
low as (select doc_id, source, pos, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\x0B\f\r]+', ' ', 'g'), ' ') as l from cut),
wide as (select l, min(struct_pack(d := doc_id, a := pos)) as first from low where length(l) >= 10 group by l having count(distinct source) >= {SITES}),
kept as (select c.doc_id, c.pos, c.line, w.l is not null and (c.doc_id <> w.first.d or c.pos <> w.first.a) as gone from low c left join wide w on c.l = w.l),
clean as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
  coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text from kept group by doc_id)
"""

_HITS = """
item_words as (select distinct item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from benchmark),
win as (select distinct item_id, least(13, len(w)) as size, array_to_string(w[i + 1 : i + least(13, len(w))], ' ') as phrase
  from item_words, unnest(range(greatest(len(w) - 12, 1))) as t(i) where len(w) > 0),
doc_words as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
sizes as (select distinct size from win),
runs as (select doc_id, size, i, array_to_string(w[i + 1 : i + size], ' ') as phrase from doc_words, sizes, unnest(range(greatest(len(w) - size + 1, 0))) as t(i)),
hits as (select r.doc_id, r.i, r.size, win.item_id from runs r join win on win.size = r.size and win.phrase = r.phrase),
spots as (select distinct doc_id, unnest(range(i, i + size)) as pos from hits),
n as (select doc_id, count(*) as n_hit from spots group by doc_id),
it as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from hits group by doc_id)
"""


def _leaf(n_chars: str) -> str:
    shown = [f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(shown)})"


#: Bytes of the id, each followed by eight shifts (-1), folded into a CRC-32.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::varchar, ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, o: case when o >= 0 then xor(c, o) else xor(c >> 1, 3988292384 * (c & 1)) end))"""

_TREE = f"""
base as (select *, {_CRC} % 7 = 0 as hit, {_leaf("n_chars")} as leaf, {_leaf("(n_chars + 1)")} as other from documents),
nodes as (select *, coalesce(lang, chr(0)) as g, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, row_number() over () as row_id from base),
levels as (select g, 0 as lvl, list(leaf order by pos) as hs from nodes group by g union all
  select g, lvl + 1, [sha256(array_to_string(hs[2 * i + 1 : 2 * i + 2], '')) for i in range((len(hs) + 1) // 2)] from levels where len(hs) > 1),
subs as (select g, hs[1] as subroot, row_number() over (order by g) - 1 as spot, lvl as height from levels where len(hs) = 1),
tops as (select 0 as lvl, list(subroot order by spot) as hs from subs union all
  select lvl + 1, [sha256(array_to_string(hs[2 * i + 1 : 2 * i + 2], '')) for i in range((len(hs) + 1) // 2)] from tops where len(hs) > 1),
steps as (select row_id, lvl, (pos >> lvl) & 1 as own, hs[xor(pos >> lvl, 1) + 1] as sibling from nodes join levels using (g) where len(hs) > 1 union all
  select row_id, height + t.lvl, (spot >> t.lvl) & 1, t.hs[xor(spot >> t.lvl, 1) + 1] from nodes join subs using (g), tops t where len(t.hs) > 1),
proof as (select row_id, list(struct_pack(o := own, s := coalesce(sibling, '')) order by lvl) as steps from steps group by row_id),
whole as (select n.*, subroot, (select hs[1] from tops where len(hs) = 1) as root, coalesce(steps, []) as steps from nodes n join subs using (g) left join proof using (row_id)),
fold as (select row_id, 0 as done, case when hit and n_chars is not null then other else leaf end as h, steps, root from whole union all
  select row_id, done + 1, sha256(case when steps[done + 1].o = 0 then h || steps[done + 1].s else steps[done + 1].s || h end), steps, root from fold where done < len(steps))
"""


def ORACLE() -> dict[str, str]:
    return {
        "op13_merkle_manifest": f"""with recursive {_TREE} select doc_id, leaf, subroot, w.root, sha256(array_to_string(list_transform(w.steps, lambda x: x.s), '')) as proof_sha256,
 f.h as folded_root, f.h = w.root as verified from whole w join fold f on f.row_id = w.row_id and f.done = len(f.steps)""",
        "op6_line_dedup": f"with {_LINES} select doc_id, n_lines, n_removed, length(text) as kept_chars, sha256(text) as text_sha256 from clean",
        "op7_decontamination": f"""with {_HITS} select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
 from doc_words d left join n using (doc_id) left join it using (doc_id)""",
    }
