"""Benchmark decontamination with a distributed positional inverted index.

The index holds postings (term, document, position) of whole texts, and the length of each document as the position of an
end mark. It keeps the terms that searches can start from. A search takes the rarest terms of each phrase, shifts their
postings to the phrase's start, intersects the shifted lists and proves what is left word by word. A proximity search
lets the lists meet within some words of each other. Only DataFrame functions run here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelwarden.llm.common import computed, plain_lower, stored

#: What stands between words: all of ASCII but digits and letters. Listed one by one, which Java matches by table.
BETWEEN = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
END = "\n"


def _words(text: Column) -> Column:
    """Words of a text as they stand; null and wordless texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def windows_of(items: DataFrame, item: str = "item_id", text: str = "text", width: int = 13) -> DataFrame:
    """Rows (item, nth, words): every run of `width` words of an item, or all words of a shorter one."""
    words = items.select(F.col(item).alias("item"), _words(plain_lower(F.col(text))).alias("w")).filter(F.size("w") > 0).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    return words.select("item", "w", F.explode(starts).alias("nth")).select(
        "item", "nth", F.slice("w", F.col("nth") + 1, F.lit(width)).alias("words")
    )


def search_terms(windows: DataFrame, each: int = 2) -> DataFrame:
    """Rows (phrase, size, term, at): for each distinct phrase the `each` terms that the fewest items use, longer first.

    Terms are in full lower case, which only adds chances; the proof of a hit uses A-Z alone. Items that share a phrase,
    rows of one id with different texts and items without id are searched by their phrases alike.
    """
    phrase = F.array_join("words", " ").alias("phrase")
    spread = windows.select("item", phrase, F.size("words").alias("size"), F.posexplode("words").alias("at", "term")).withColumn("term", F.lower("term"))
    used = spread.groupBy("term").agg(F.count_distinct("item").alias("items"))
    order = Window.partitionBy("phrase").orderBy("items", F.desc(F.length("term")), "term", "at")
    places = spread.select("phrase", "size", "term", "at").distinct()
    ranked = places.join(used, "term").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= each)
    return ranked.select("phrase", "size", "term", "at")


def positional_index(docs: DataFrame, terms: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (doc, twin, at, term) of the given terms in whole texts, with one end mark a row of `docs`.

    `twin` is a hash of the text, which keeps apart rows of one id. Words shorter than every term are passed over
    before rows are made. The term table is small beside the corpus and joins by Spark's own choice of plan.
    """
    shortest = terms.agg(F.coalesce(F.min(F.length("term")), F.lit(1)).alias("shortest"))
    words = computed(docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("twin"), F.col(text).alias("t")), w=_words(F.col("t"))).drop("t")
    words = words.crossJoin(F.broadcast(shortest))
    places = F.filter(F.transform("w", lambda w, i: F.struct(i.alias("at"), w.alias("term"))), lambda p: F.length(p["term"]) >= F.col("shortest"))
    places = F.concat(places, F.array(F.struct(F.size("w").alias("at"), F.lit(END).alias("term"))))
    rows = words.select("doc", "twin", F.explode(places).alias("p")).select("doc", "twin", F.col("p.at").alias("at"), F.lower("p.term").alias("term"))
    wanted = terms.select("term").union(terms.sparkSession.range(1).select(F.lit(END).alias("term"))).distinct()
    return rows.join(wanted, "term").select("doc", "twin", "at", "term")


def phrase_starts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (doc, twin, start, size, phrase): places where the shifted lists of a phrase's terms meet.

    The rarest term by length of its list leads; every other search term of the phrase must stand at its offset.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("phrase").orderBy("n", "at")
    ranked = terms.join(counts, "term").withColumn("lead", F.row_number().over(order) == 1)
    needed = terms.groupBy("phrase").agg(F.count(F.lit(1)).alias("parts"))
    leads = ranked.filter("lead").join(needed, "phrase").select("term", "size", "phrase", "parts", F.col("at").alias("shift"))
    spots = index.filter(F.col("term") != END).join(leads, "term").select(
        "doc", "twin", (F.col("at") - F.col("shift")).alias("start"), "size", "phrase", "parts"
    ).filter("start >= 0")
    single = spots.filter("parts = 1").drop("parts")
    others = ranked.filter("not lead").select("phrase", F.col("term").alias("t"), F.col("at").alias("shift"))
    asked = spots.filter("parts > 1").join(others, "phrase").withColumn("at", F.col("start") + F.col("shift"))
    lists = index.filter(F.col("term") != END).select(F.col("doc").alias("d"), F.col("twin").alias("w"), F.col("at").alias("a"), F.col("term").alias("t2"))
    met = asked.join(lists, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")) & (F.col("at") == F.col("a")) & (F.col("t") == F.col("t2")), "left_semi")
    return single.union(met.select(*single.columns)).distinct()


def proved_hits(docs: DataFrame, spots: DataFrame, holds: Callable[[Column], Column], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc, twin, hits): the spots for which `holds` is true beside the document's `words`, as an array of (start, size, phrase)."""
    asked = spots.groupBy("doc", "twin").agg(F.collect_set(F.struct("start", "size", "phrase")).alias("asked"))
    texts = docs.select(F.col(doc).alias("d"), F.xxhash64(text).alias("w"), F.col(text).alias("t"))
    both = texts.join(asked, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")))
    both = computed(both, words=_words(plain_lower(F.col("t")))).drop("t")
    return both.select("doc", "twin", F.filter("asked", holds).alias("hits")).filter(F.size("hits") > 0).dropDuplicates(["doc", "twin"])


def exact_hits(docs: DataFrame, spots: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc, twin, hits): the spots that hold word by word, as an array of (start, size, phrase) for each document."""
    return proved_hits(docs, spots, lambda s: F.array_join(F.slice(F.col("words"), s["start"] + 1, s["size"]), " ") == s["phrase"], doc, text)


def items_hit(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (doc, twin, items): the sorted ids (as strings) of the items whose windows occur in a document; null ids are left out."""
    owners = windows.filter("item is not null").select(F.array_join("words", " ").alias("phrase"), F.col("item").cast("string").alias("item")).distinct()
    phrases = hits.select("doc", "twin", F.explode("phrases").alias("phrase"))
    return phrases.join(owners, "phrase").groupBy("doc", "twin").agg(F.array_sort(F.collect_set("item")).alias("items"))


def near_starts(index: DataFrame, terms: DataFrame, slack: int) -> DataFrame:
    """Rows (doc, twin, start, size, phrase): places where two search terms of a phrase stand in order, within `slack` words of their distance.

    Every pair of a phrase's terms is tried, the rarer one by length of its list leads; one-word phrases have one term, which stands alone.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ends = F.array_sort(F.collect_list(F.struct("n", "at", "term")))
    lists = terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0))).groupBy("phrase", "size").agg(ends.alias("e"))
    pairs = F.flatten(F.transform("e", lambda a, i: F.transform(F.slice("e", i + 2, F.size("e")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    leads = lists.select("phrase", "size", F.explode(pairs).alias("p")).select("phrase", "size", F.col("p.a.term").alias("term"), F.col("p.a.at").alias("shift"), F.col("p.b.term").alias("t"), (F.col("p.b.at") - F.col("p.a.at")).alias("apart"))
    words = index.filter(F.col("term") != END)
    place = ["doc", "twin", (F.col("at") - F.col("shift")).alias("start"), "size", "phrase"]
    single = words.join(lists.filter("size(e) = 1").select("phrase", "size", F.col("e")[0]["term"].alias("term"), F.col("e")[0]["at"].alias("shift")), "term").select(*place)
    near = F.filter(F.sequence(F.col("apart") - slack, F.col("apart") + slack), lambda d: d * F.col("apart") > 0)
    asked = words.join(leads, "term").select(*place, "t", "at", F.explode(near).alias("d")).withColumn("at", F.col("at") + F.col("d")).drop("d")
    held = words.select(F.col("doc").alias("d"), F.col("twin").alias("w"), F.col("at").alias("a"), F.col("term").alias("t2"))
    met = asked.join(held, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")) & (F.col("at") == F.col("a")) & (F.col("t") == F.col("t2")), "left_semi")
    return single.union(met.select(*single.columns)).distinct()


def proximity(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 13, slack: int = 2, lost: int = 5) -> DataFrame:
    """Proximity matches, one row per document (id and text) that has any: (doc, twin, n_windows, items).

    * A window matches at a place where two of its three search terms stand in order, within `slack` words of their distance, and
      where at most one in `lost` of its words (none in a shorter window) is missing from its place and `slack` words around. So a
      window with one word changed, inserted or dropped always matches, and an exact one does.
    * n_windows: distinct phrases that match; items: as in `contamination`, which these matches don't touch.
    """
    windows = windows_of(items, item, item_text, width)
    terms = stored(search_terms(windows, 3), "terms")
    index = stored(positional_index(docs, terms, doc, text), "postings")
    first = lambda s: F.greatest(s["start"] - slack, F.lit(0))
    around = lambda s: F.slice(F.col("words"), first(s) + 1, s["start"] + s["size"] + slack - first(s))
    holds = lambda s: F.size(F.array_except(F.split(s["phrase"], " "), around(s))) * lost <= s["size"]
    hits = proved_hits(docs, near_starts(index, terms, slack), holds, doc, text)
    found = stored(hits.select("doc", "twin", F.array_distinct(F.transform("hits", lambda h: h["phrase"])).alias("phrases")), "hits")
    named = items_hit(found, windows).withColumnsRenamed({"doc": "d", "twin": "w"})
    return found.join(named, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")), "left").select(
        "doc", "twin", F.size("phrases").cast("long").alias("n_windows"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def contamination(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 13, share: int = 20) -> DataFrame:
    """One row per row of `docs`: (doc, twin, n_words, n_hit, items, spans, contaminated).

    * n_hit: words of the document inside any occurrence of a window; items: sorted ids (as strings) with occurring
      windows (items without id count in n_hit, not here); spans: (start, size) of the occurrences in words;
      contaminated: n_hit > 0 and share * n_hit >= n_words.
    * Null and wordless texts have no words and are clean. Items without words, and null items, hit nothing. Repeated
      rows (same id and text) get the same result, one each. Without items nothing is contaminated.
    """
    windows = windows_of(items, item, item_text, width)
    terms = stored(search_terms(windows), "terms")
    index = stored(positional_index(docs, terms, doc, text), "postings")
    hits = exact_hits(docs, phrase_starts(index, terms), doc, text)
    inside = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))
    found = stored(hits.select(
        "doc", "twin", F.size(inside).cast("long").alias("n_hit"), F.array_distinct(F.transform("hits", lambda h: h["phrase"])).alias("phrases"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["size"].alias("size"))))).alias("spans"),
    ), "hits")
    named = items_hit(found, windows).withColumnsRenamed({"doc": "d", "twin": "w"})
    found = found.join(named, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")), "left").select(
        F.col("doc").alias("d"), F.col("twin").alias("w"), "n_hit", "items", "spans"
    )
    every = index.filter(F.col("term") == END).select("doc", "twin", F.col("at").cast("long").alias("n_words"))
    out = every.join(found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("twin") == F.col("w")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc", "twin", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 13, share: int = 20) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their own columns."""
    bad = contamination(docs, items, doc, text, item, item_text, width, share).filter("contaminated").select(F.col("doc").alias("__d"), F.col("twin").alias("__w"))
    keyed = docs.withColumn("__twin", F.xxhash64(text))
    return keyed.join(bad, F.col(doc).eqNullSafe(F.col("__d")) & (F.col("__twin") == F.col("__w")), "left_anti").drop("__twin")
