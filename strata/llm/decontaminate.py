"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import broadcast_if_small, kept

WINDOW = 10
GRAM = 5

# Fixed: after A-Z became a-z, a word is a run of digits, a-z and anything beyond ASCII.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text; null has none. Only A-Z change case, so a text beyond ASCII
    cannot take the fast way."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.coalesce(
        F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>")
    )


def _each(size: Column, value) -> Column:
    """An array of value(0), value(1), ... of that size, empty if size is 0 or less."""
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, value)


def winnow(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Add ``_least``: for every run of ``window`` words the least hash of its
    ``gram``-grams, from ``_words``. Two runs of equal words have the same."""
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    h = F.col("_hashes")
    grams = _each(
        F.size(h) - (gram - 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(gram)])
    )
    rows = rows.withColumn("_grams", grams).drop("_hashes")
    g, wide = F.col("_grams"), window - gram + 1
    if wide == 1:
        return rows.withColumnRenamed("_grams", "_least")
    least = _each(
        F.size(g) - (wide - 1), lambda i: F.least(*[F.get(g, i + j) for j in range(wide)])
    )
    return rows.withColumn("_least", least).drop("_grams")


def _span(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("_words", start + 1, length), " ")


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item``, ``size`` in words and ``span``, the words of each window of each item;
    a shorter item is one window."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("_words"))
    rows = rows.where(F.size("_words") > 0).withColumn("size", F.least(F.size("_words"), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size("_words") - F.col("size"))
    return (
        rows.withColumn("_start", F.explode_outer(starts))
        .select("item", "size", F.array_join(F.slice("_words", F.col("_start") + 1, F.col("size")), " ").alias("span"))
        .distinct()
    )


def _places(docs: DataFrame, spans: DataFrame, known: int, size: int, gram: int) -> DataFrame:
    """Rows of ``docs`` with ``start`` and ``end`` for every run of windows of ``size`` words
    with one winnowed hash that some span has too, and one row with start -1 for each row
    of docs. No words leave the scan, so a shuffle moves a few numbers a place."""
    looked = winnow(
        spans.where(F.col("size") == size).select("span", F.split("span", " ").alias("_words")),
        size,
        gram,
    )
    prints = looked.select(F.col("_least")[0].alias("_print")).distinct()
    rows = winnow(docs, size, gram)
    least = F.col("_least")
    chosen = F.filter(
        _each(F.size(least), lambda i: i),
        lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1)),
    )
    # The outer form, as the plain one adds a filter that computes all arrays again.
    rows = rows.withColumn("_chosen", F.concat(chosen, F.array(F.lit(-1))))
    rows = rows.select("*", F.posexplode_outer("_chosen").alias("_place", "start"))
    # Where a run of windows with one least hash ends; the last entry marks the row itself.
    after = F.get("_chosen", F.col("_place") + 1)
    end = F.when(after >= 0, after).otherwise(F.size("_least"))
    own = F.when(F.col("start") < 0, F.xxhash64("_id", "_text")).otherwise(
        F.get("_least", F.col("start"))
    )
    rows = rows.select(
        "_id", "_text", "n_words", "start", end.alias("end"), F.lit(size).alias("size"), own.alias("_print")
    )
    return (
        rows.join(broadcast_if_small(prints.withColumn("_known", F.lit(True)), known), "_print", "left")
        .where("_known OR start < 0")
        .drop("_print", "_known")
    )


def _confirmed(
    docs: DataFrame, text: str, places: DataFrame, spans: DataFrame, known: int
) -> DataFrame:
    """``_id``, ``_text``, ``start``, ``size`` and ``span`` where a span occurs: the windows at
    the places found, with the same words. Only texts with such places are read again, and
    equal rows once."""
    key = ["_id", "_text"]
    runs = places.groupBy(*key).agg(F.collect_set(F.struct("size", "start", "end")).alias("_runs"))
    runs = kept(runs, "places")
    a, b = docs.alias("a"), broadcast_if_small(runs.select(*key), runs.count()).alias("b")
    same = F.col("a._id").eqNullSafe(F.col("b._id")) & F.col("a._text").eqNullSafe(F.col("b._text"))
    texts = a.join(b, same, "left_semi").dropDuplicates(key).alias("a")
    rows = texts.join(runs.alias("b"), same).select("a.*", "b._runs")
    rows = rows.select(*key, words(F.col(text)).alias("_words"), F.explode_outer("_runs").alias("_run"))
    rows = rows.select(
        *key,
        "_words",
        "_run.size",
        F.explode_outer(F.sequence(F.col("_run.start"), F.col("_run.end") - 1)).alias("start"),
    )
    rows = rows.select(*key, "start", "size", _span(F.col("start"), F.col("size")).alias("span"))
    return rows.join(broadcast_if_small(spans, known), ["size", "span"], "left_semi")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``_text`` (the md5 of its text), ``n_words``,
    ``spans`` (starts and ends of hit words, merged), ``n_hit`` and ``items``, the ids of
    items that occur, as sorted strings.

    A window is ``window`` words in a row of an item, or a whole shorter item. Winnowing
    keeps the least hash of ``gram`` words of every window, so each occurrence of a
    window shares a kept hash. Documents look theirs up, and every hit is confirmed on
    the words. Items shorter than a window have their own size looked up.

    The items' hashes are broadcast only if few; beyond, the hashes of the documents are
    shuffled, without words. Texts with places that share a hash are read once more, for
    their words. What is left then is one row per document and its hits.

    Null and empty texts have no words; an empty or null item has no window; an item
    without id hits words but is not listed. Repeated rows each get their own result,
    other columns are not read.
    """
    windows = kept(item_windows(items, item_id, item_text, window), "windows")
    spans = kept(windows.select("size", "span").distinct(), "spans")
    sizes = {r["size"]: r["rows"] for r in spans.groupBy("size").agg(F.count("*").alias("rows")).collect()}
    texts = F.col(f"`{text}`")
    named = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.md5(texts).alias("_text"), texts.alias("_whole"))
    rows = named.select("_id", "_text", words(F.col("_whole")).alias("_words"))
    rows = rows.withColumn("n_words", F.size("_words"))
    found = None
    for size in sorted({window, *sizes}, reverse=True):
        part = _places(rows, spans, sizes.get(size, 0), size, gram if size == window else size)
        if size != window:
            part = part.where("start >= 0")
        found = part if found is None else found.union(part)
    key = ["_id", "_text"]
    found = kept(found, "looked-up")
    every = sum(sizes.values())
    hits = _confirmed(named, "_whole", found.where("start >= 0"), spans, every)
    hits = hits.withColumn("n_words", F.lit(None).cast("int"))
    marks = found.where("start < 0").withColumn("span", F.lit(None).cast("string"))
    columns = [*key, "n_words", "start", "size", "span"]
    checked = kept(marks.select(*columns).union(hits.select(*columns)), "hits")
    per_doc = checked.groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.count_if(F.col("start") < 0).alias("_rows"),
        F.collect_set(F.when(F.col("start") >= 0, F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("_hit"),
    )
    listed = (
        checked.where("start >= 0")
        .select(*key, "size", "span")
        .distinct()
        .join(windows, ["size", "span"])
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    a, b = per_doc.alias("a"), listed.alias("b")
    same = F.col("a._id").eqNullSafe(F.col("b._id")) & F.col("a._text").eqNullSafe(F.col("b._text"))
    return (
        a.join(b, same, "left")
        .select(
            "a.*",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            _merged(F.array_sort("_hit")).alias("spans"),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]))
        .drop("_copy", "_rows", "_hit")
    )


def _merged(hits: Column) -> Column:
    """Sorted starts and ends, those that touch as one."""
    kind = "array<struct<start:int,end:int>>"

    def add(done: Column, hit: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], hit["end"]).alias("end")
        )
        return (
            F.when(
                (F.size(done) > 0) & (hit["start"] <= F.try_element_at(done, F.lit(-1))["end"]),
                F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
            )
            .otherwise(F.concat(done, F.array(hit)))
            .cast(kind)
        )

    return F.aggregate(hits, F.array().cast(kind), add)
