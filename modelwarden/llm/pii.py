"""Personal data: patterns find protected values, corpus co-occurrence finds the terms that give them away.

Base spans (email, ip, card, phone) are matched in the whole text. For each term that stands near a protected value, the
corpus tells how much of the value's information it carries: with N texts, PMI(e; t) = log2(n_et * N / (n_e * n_t)) against
IC(e) = log2(N / n_e). A term that carries more than the disclosure threshold is generalised, and removed where it tells
all but everything; that holds wherever it occurs. Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import computed, plain_lower, stored
from modelwarden.llm.decontam import BETWEEN

#: Fixed patterns. Possessive, and starting where a leftmost search would, so that failing runs are not tried again:
#: \G is the end of the last match. Card runs have 13 to 19 digits; the run before and after must end there.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text can match at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = (*PATTERNS, "term", "gone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "gone": ""}
SPAN = "array<struct<start:bigint,end:bigint,value:string,near:string>>"


def running_totals(values: Column, chunk: int = 64) -> Column:
    """Inclusive running sums of an array of longs; by chunks, so that long arrays are not copied for each element."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def grow(part: Column, base: Column) -> Column:
        start = F.struct(base.alias("sum"), none.alias("all"))
        step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + x)).alias("all"))
        return F.aggregate(part, start, step, lambda acc: acc["all"])

    count = F.ceil(F.size(values) / chunk).cast("int")
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * chunk + 1, F.lit(chunk)))
    sums = F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: a + x))
    bases = F.concat(F.array(zero), grow(sums, zero))
    whole = F.flatten(F.zip_with(parts, F.slice(bases, 1, F.size(parts)), grow))
    return F.when(F.size(values) == 0, none).when(F.size(values) <= chunk, grow(values, zero)).otherwise(whole)


def luhn(digits: Column) -> Column:
    """True when a string of digits passes the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits), "(?!^)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.floor(d.cast("int") * 2 / 10) + d.cast("int") * 2 % 10).cast("long"))
    return F.aggregate(figures, F.lit(0).cast("long"), lambda a, x: a + x) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """The conditions that a match of a pattern must meet."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(F.regexp_replace(value, "[^0-9]", ""))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, text: str = "text", reach: int = 64) -> DataFrame:
    """Adds one array column a base kind: (start, end, value, near), offsets in code points, end exclusive.

    `near` is the text up to `reach` code points before and after the value, but no more than up to the next value of
    the kind. Null texts have no spans.
    """
    columns: dict[str, Column] = {}
    for kind, pattern in PATTERNS.items():
        may = F.col(text).rlike("[0-9]") if HINTS[kind] is None else F.contains(F.col(text), F.lit(HINTS[kind]))
        columns[f"__{kind}_hits"] = F.when(may, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    found = computed(docs, **columns)
    columns = {}
    for kind, pattern in PATTERNS.items():
        columns[f"__{kind}_gaps"] = F.when(F.size(f"__{kind}_hits") > 0, F.split(F.col(text), pattern, -1))
    found = computed(found, **columns)
    columns = {}
    for kind in PATTERNS:
        hits, gaps = F.col(f"__{kind}_hits"), F.col(f"__{kind}_gaps")
        steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
        columns[f"__{kind}_steps"] = F.when(F.size(hits) > 0, steps)
    found = computed(found, **columns)
    columns = {}
    for kind in PATTERNS:
        columns[f"__{kind}_ends"] = F.when(F.col(f"__{kind}_steps").isNotNull(), running_totals(F.col(f"__{kind}_steps")))
    found = computed(found, **columns)
    columns = {}
    for kind in PATTERNS:
        hits, gaps = F.col(f"__{kind}_hits"), F.col(f"__{kind}_gaps")
        zipped = F.arrays_zip(hits.alias("h"), F.slice(gaps, 1, F.size(hits)).alias("a"), F.slice(gaps, 2, F.size(hits)).alias("b"), F.col(f"__{kind}_ends").alias("e"))
        spans = F.transform(
            F.filter(zipped, lambda z: holds(kind, z["h"])),
            lambda z: F.struct(
                (z["e"] - F.length(z["h"])).alias("start"), z["e"].alias("end"), z["h"].alias("value"),
                F.concat_ws(" ", F.right(z["a"], F.lit(reach)), F.left(z["b"], F.lit(reach))).alias("near"),
            ),
        )
        columns[kind] = F.coalesce(F.when(F.col(f"__{kind}_ends").isNotNull(), spans), F.array().cast(SPAN))
    return computed(found, **columns).drop(*[f"__{k}_{c}" for k in PATTERNS for c in ("hits", "gaps", "steps", "ends")])


def terms_in(text: Column, least: int) -> Column:
    """Distinct words of a text with `least` characters or more, as they stand."""
    return F.array_distinct(F.filter(F.split(text, BETWEEN), lambda w: F.length(w) >= least))


def values_in(spans: DataFrame) -> DataFrame:
    """Rows (twin, near, entity): the protected values of each text, entities being equal where values differ in form only."""
    every = F.concat(*[F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["value"].alias("value"), s["near"].alias("near"))) for kind in PATTERNS])
    return spans.select("twin", F.explode(every).alias("v")).select(
        "twin", "v.near",
        F.concat("v.kind", F.lit(":"), F.when(F.col("v.kind").isin("card", "phone"), F.regexp_replace("v.value", "[^0-9]", "")).otherwise(F.lower("v.value"))).alias("entity"),
    )


def near_terms(rows: DataFrame, support: int, least: int) -> DataFrame:
    """Rows (entity, n_e, term): terms that stand near a protected value in `support` texts; n_e is the number of texts with the value."""
    entities = rows.groupBy("entity").agg(F.count_distinct("twin").alias("n_e")).filter(F.col("n_e") >= support)
    near = rows.join(entities, "entity").select("entity", "n_e", "twin", F.explode(terms_in(F.col("near"), least)).alias("term"))
    near = near.withColumn("term", plain_lower(F.col("term"))).filter(~F.col("term").rlike("[0-9]"))
    return near.groupBy("entity", "n_e", "term").agg(F.count_distinct("twin").alias("n_et")).filter(F.col("n_et") >= support).drop("n_et")


def text_words(docs: DataFrame, text: str, least: int) -> DataFrame:
    """Rows (twin, words): the distinct lower-case terms of each distinct text."""
    return docs.select(F.xxhash64(text).alias("twin"), terms_in(plain_lower(F.col(text)), least).alias("words")).dropDuplicates(["twin"])


def rare_enough(near: DataFrame, words: DataFrame, texts: int, share: float) -> DataFrame:
    """`near` with n_t, the number of distinct texts with the term, without pairs that cannot reach the share.

    n_et is at most n_e, so a term can tell `share` of the information of a value only if
    n_t <= n_e * (texts / n_e) ** (1 - share). Terms are counted in each task before the shuffle.
    """
    counts = words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    most = F.col("n_e") * F.pow(F.lit(float(texts)) / F.col("n_e"), F.lit(1 - share)) * (1 + 1e-9)
    return near.join(counts, "term").filter((F.col("n_e") < texts) & (F.col("n_t") <= most)).select("entity", "n_e", "term", "n_t")


def term_places(words: DataFrame, near: DataFrame) -> DataFrame:
    """Rows (twin, term): the distinct texts that hold the terms of `near`."""
    return words.select("twin", F.explode("words").alias("term")).join(near.select("term").distinct(), "term").select("twin", "term")


def whole_counts(near: DataFrame, rows: DataFrame, places: DataFrame) -> DataFrame:
    """Adds n_et to the pairs of `near`: the number of distinct texts that hold term and value anywhere."""
    held = rows.select("entity", "twin").distinct().join(near.select("entity").distinct(), "entity")
    both = held.join(places, "twin").join(near, ["entity", "term"])
    return both.groupBy("entity", "n_e", "term", "n_t").agg(F.count(F.lit(1)).alias("n_et"))


def disclosing_terms(joint: DataFrame, texts: int, share: float, all_of: float) -> DataFrame:
    """Rows (term, kind): the terms that carry at least `share` of the information of some protected value.

    kind is `gone` for terms that occur in hardly any text without the value (n_et / n_t >= all_of), else `term`.
    """
    pmi = F.log2(F.col("n_et") * float(texts) / (F.col("n_e") * F.col("n_t")))
    told = joint.filter(pmi >= share * F.log2(float(texts) / F.col("n_e")))
    told = told.groupBy("term").agg(F.max(F.col("n_et") / F.col("n_t")).alias("p"))
    return told.select("term", F.when(F.col("p") >= all_of, "gone").otherwise("term").alias("kind"))


def term_spans(docs: DataFrame, terms: DataFrame, places: DataFrame, ids: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc, twin, found): for documents with disclosing terms, the (kind, start, end) of each occurrence.

    ids: the (doc, twin) of all rows.
    """
    held = places.join(terms, "term").groupBy("twin").agg(F.map_from_entries(F.collect_set(F.struct("term", "kind"))).alias("kinds"))
    quoted = F.array_join(F.transform(F.array_sort(F.map_keys("kinds")), lambda t: F.concat(F.lit("\\Q"), t, F.lit("\\E"))), "|")
    inside = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    held = ids.distinct().join(held, "twin").select(F.col("doc").alias("d"), F.col("twin").alias("w"), "kinds", F.concat(F.lit(rf"(?<!{inside})(?:"), quoted, F.lit(rf")(?!{inside})")).alias("pattern"))
    keyed = docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("twin"), F.col(text).alias("t"))
    both = keyed.join(held, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w"))).dropDuplicates(["doc", "twin"])
    both = computed(both, low=plain_lower(F.col("t")))
    both = computed(both, hits=F.expr("regexp_extract_all(low, pattern, 0)"), gaps=F.expr("split(low, pattern, -1)"))
    both = computed(both, steps=F.zip_with(F.slice("gaps", 1, F.size("hits")), F.col("hits"), lambda g, h: (F.length(g) + F.length(h)).cast("long")))
    both = computed(both, ends=running_totals(F.col("steps")))
    zipped = F.arrays_zip(F.col("hits").alias("h"), F.col("ends").alias("e"))
    found = F.transform(zipped, lambda z: F.struct(F.element_at(F.col("kinds"), z["h"]).alias("kind"), (z["e"] - F.length(z["h"])).alias("start"), z["e"].alias("end")))
    return both.select("doc", "twin", found.alias("found"))


def personal_data(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", share: float = 0.95, support: int = 3, all_of: float = 0.95, least: int = 5,
) -> DataFrame:
    """Rows (doc, twin, spans), one for each row of `docs`; spans are (order, kind, start, end), by kind as listed, then start.

    Kinds are email, ip, card and phone (base spans, by pattern alone), then term and gone (words that give a protected
    value away; none inside a base span). `twin` is a hash of the text. Counts are over distinct texts, so exact copies
    count once; a term needs `support` texts in which it stands near the value, and `least` characters, no digits.
    What it tells is counted over whole texts: those that hold term and value anywhere.
    Null text has no spans. Repeated rows get the same spans. An empty table gives none.
    """
    keyed = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.xxhash64(text).alias("twin"))
    spans = stored(base_spans(keyed, "t").drop("t"), "base")
    texts = spans.agg(F.count_distinct("twin")).first()[0]
    near = stored(near_terms(values_in(spans), support, least), "near")
    words = stored(text_words(docs, text, least), "words", compression="zstd")
    near = stored(rare_enough(near, words, texts, share), "rare")
    places = stored(term_places(words, near), "places")
    terms = stored(disclosing_terms(whole_counts(near, values_in(spans), places), texts, share, all_of), "terms")
    added = term_spans(docs, terms, places, spans.select("doc", "twin"), doc, text).withColumnsRenamed({"doc": "__d", "twin": "__w"})
    base = F.concat(*[F.transform(kind, lambda s: F.struct(F.lit(i).alias("order"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))) for i, kind in enumerate(PATTERNS)])
    rows = computed(spans.select("doc", "twin", base.alias("b")), base=F.col("b")).drop("b")
    rows = rows.join(added, F.col("doc").eqNullSafe(F.col("__d")) & (F.col("twin") == F.col("__w")), "left")
    free = F.filter(F.coalesce("found", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")), lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    more = F.transform(free, lambda s: F.struct(F.when(s["kind"] == "term", KINDS.index("term")).otherwise(KINDS.index("gone")).alias("order"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc", "twin", F.array_sort(F.concat("base", more)).alias("spans"))


def sanitised(docs: DataFrame, found: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with the spans of `personal_data` taken out of `text`: base values and generalised terms by a label, removed terms by nothing.

    Of overlapping spans the one that starts first wins (then the first listed kind).
    """
    spans = found.select(F.col("doc").alias("__d"), F.col("twin").alias("__w"), F.col("spans").alias("__spans")).filter(F.size("__spans") > 0).dropDuplicates(["__d", "__w"])
    keyed = docs.withColumn("__twin", F.xxhash64(text))
    rows = keyed.join(spans, F.col(doc).eqNullSafe(F.col("__d")) & (F.col("__twin") == F.col("__w")), "left")
    place = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["kind"].alias("kind"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        label = F.lit("")
        for kind, shown in LABELS.items():
            label = F.when(s["kind"] == kind, shown).otherwise(label)
        piece = F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        grown = F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(piece, label)).alias("parts"))
        return F.when(s["start"] < acc["at"], acc).otherwise(grown)

    done = computed(rows, __done=F.aggregate(place, start, step))
    clean = F.concat(F.array_join("__done.parts", ""), F.substr(F.col(text), (F.col("__done.at") + 1).cast("int")))
    return done.select(*[F.when(F.size("__spans") > 0, clean).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in docs.columns])
