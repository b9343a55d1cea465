"""Benchmark decontamination by word and template windows, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved

WINDOW = 5
COVERAGE = 0.8
NUMBER, NAME, UNIT, JOINT = "\ue001", "\ue002", "\ue003", "\ue004"
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec min h hr hrs hour hours day days week weeks "
    "month months year years m2 km2 m3 kmh mph k c f w kw v a hz usd eur gbp dollars euros cents percent"
)
MARKS = f"[{NUMBER}{NAME}{UNIT}]"
#: Windows of a passage may drift by so many words against the item, as words are put in or left out.
DRIFT = 8
#: More window hashes than this (32 MB) are joined by a shuffle and not sent to every executor.
MOST_SENT = 1 << 22

_WORD = r"\p{Lu}\p{Ll}[\p{L}\p{M}\p{N}]*+"
_UNIT = f"(?:{UNITS.replace(' ', '|')})"
TEMPLATE, PLAIN, FOUR, THREE, WHOLE = range(5)
_LENGTH = {TEMPLATE: WINDOW, PLAIN: WINDOW, FOUR: 4, THREE: 3}


def evened(text: Column) -> Column:
    """Words of letters, marks and digits, one space apart; placeholder signs of the text are gone."""
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\p{L}\p{M}\p{N}]+", " "))


def template(even: Column) -> Column:
    """Placeholders for runs of capitalised words, runs of numbers, and units behind them; the rest in lower case."""
    out = F.lower(F.regexp_replace(even, f"(^| ){_WORD}(?: {_WORD})*+", f"$1{NAME}"))
    out = F.regexp_replace(out, f"(^| )[0-9]++(?: [0-9]++)*+ ?{_UNIT}(?= |$)", f"$1{NUMBER} {UNIT}")
    return F.regexp_replace(out, "(^| )[0-9]++(?: [0-9]++)*+", f"$1{NUMBER}")


def valued(even: Column) -> Column:
    """The same words as ``template``, in which placeholders are followed by their values."""
    joined = F.regexp_replace(even, r"(?<=(?:^| )\p{Lu}\p{Ll}[\p{L}\p{M}\p{N}]{0,200}) (?=\p{Lu}\p{Ll})", JOINT)
    out = F.lower(F.regexp_replace(joined, f"(^| )(\\p{{Lu}}\\p{{Ll}}[\\p{{L}}\\p{{M}}\\p{{N}}{JOINT}]*+)", f"$1{NAME}$2"))
    out = F.regexp_replace(out, "(?<=(?:^| )[0-9]{1,200}) (?=[0-9])", JOINT)
    out = F.regexp_replace(out, f"(^| )([0-9][0-9{JOINT}]*+) ?({_UNIT})(?= |$)", f"$1{NUMBER}$2 {UNIT}$3")
    return F.regexp_replace(out, f"(^| )([0-9][0-9{JOINT}]*+)", f"$1{NUMBER}$2")


def _runs(words: str, view: int) -> Column:
    """Hashes of all runs of a view's length, in order."""
    length = _LENGTH[view]
    last = F.size(words) - length
    hashed = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(view), *[F.get(words, i + k) for k in range(length)])
    )
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _hashes(rows: DataFrame, keep: list[str], text: str, views: list[int]) -> DataFrame:
    """``keep`` columns with one array of window hashes per view, ``_0`` to ``_4``."""
    rows = rows.select(*keep, evened(F.col(text)).alias("_even"))
    rows = rows.select(*keep, F.lower("_even").alias("_plain"), template(F.col("_even")).alias("_template"))
    words = rows.select(*keep, "_plain", F.split("_plain", " ").alias("_w"), F.split("_template", " ").alias("_t"))
    made = {v: _runs("_t" if v == TEMPLATE else "_w", v) for v in views if v != WHOLE}
    if WHOLE in views:
        made[WHOLE] = F.array(F.xxhash64(F.lit(WHOLE), F.col("_plain")))
    return words.select(*keep, *[made[v].alias(f"_{v}") for v in views])


def _items(benchmark: DataFrame, item: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Windows of the items that differ, (``_class``, ``_view``, ``hash``, ``_at``, ``_n``), and the items of each class."""
    rows = benchmark.where(F.col(item).isNotNull()).select(F.col(item).alias("_item"), F.col(text).cast("string").alias("_text"))
    rows = rows.where(evened(F.col("_text")) != "").distinct()
    made = _hashes(rows, ["_item", "_text"], "_text", list(range(5)))
    count = F.size(F.split(evened(F.col("_text")), " "))
    fits = {TEMPLATE: count >= 1, PLAIN: count >= WINDOW, FOUR: count == 4, THREE: count == 3, WHOLE: count < 3}
    views = [F.when(ok, F.struct(F.lit(v).alias("_view"), F.col(f"_{v}").alias("_all"))) for v, ok in fits.items()]
    made = made.select("_item", "_text", F.explode(F.array_compact(F.array(*views))).alias("_v")).select("_item", "_text", "_v.*")
    made = saved(made.where(F.size("_all") > 0).withColumn("_class", F.xxhash64("_view", "_all")), "items")
    members = made.select("_class", "_view", "_all", "_item", "_text").distinct()
    classes = made.select("_class", "_view", "_all").distinct()
    classes = classes.select("_class", "_view", F.size("_all").alias("_n"), F.posexplode("_all").alias("_at", "hash"))
    return saved(classes, "item_windows"), members


def _anchors(windows: DataFrame, coverage: float) -> DataFrame:
    """Of each item the windows that fewest items have, so many that one must be there if the item is.

    If ``coverage`` of the windows are found, at most the rest are missing: among one more than
    these is one that is found.
    """
    shared = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("_times"))
    ranked = windows.join(shared, "hash").groupBy("_class", "_view", "_n").agg(
        F.sort_array(F.collect_list(F.struct("_times", "hash"))).alias("_order")
    )
    needed = F.floor(F.col("_n") * (1 - coverage) + 1e-9).cast("int") + 1
    return ranked.select("_class", "_view", F.explode(F.slice("_order", F.lit(1), needed)).alias("_o")).select(
        "_class", "_view", "_o.hash"
    ).distinct()


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    *,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other numbers, names and units.

    One row per pair: ``key``, ``item``, ``n_windows`` of the item, ``n_found``, ``coverage``,
    ``n_slots`` (different pairs of slot values, 0 for an item found word for word) and
    ``verbatim``. Case, punctuation and white space do not count.

    Word for word: five-word windows of lower-case words. Items of three or four words are one
    window; shorter ones match a document that consists of their words. With other values: runs
    of capitalised words, sentence starts included, runs of numbers and units behind them
    become typed placeholders, and five-word windows of the template are compared. Either way a
    pair counts if at least 0.8 of the item's windows stand in one place, that is, in the
    item's order give or take eight words. In a template match slot values must correspond
    one to one: equal values stay equal and different ones different. A placeholder at either end of
    the item is not compared, as its run may go on in the text around it.

    Windows of the documents that no item has are dropped at once. Only items of which one of
    the rarest windows is found are compared further (``_anchors``), so windows that many items
    share pair nothing up.

    Rows with a null key on either side are left out; null and empty texts match nothing. Rows
    with equal keys count as one document or item; equal items are compared once and reported
    each. A very long text is one array of its windows' hashes. Extra columns are ignored; an
    empty table on either side gives no rows.
    """
    spark = documents.sparkSession
    windows, members = _items(benchmark, item, item_text)
    hashes = saved(windows.select("hash").distinct(), "item_hashes")
    views = sorted(row[0] for row in windows.select("_view").distinct().collect())
    docs = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    known = F.broadcast(hashes) if hashes.count() <= MOST_SENT else hashes
    made = _hashes(docs, ["_key"], "_text", views or [PLAIN])
    every = F.concat(*[F.col(f"_{v}") for v in views or [PLAIN]])  # templates first, so that their places are their own
    hits = made.select("_key", F.posexplode(every).alias("_pos", "hash")).join(known, "hash", "left_semi")
    hits = saved(hits, "hits")

    anchors = _anchors(windows, coverage)
    pairs = hits.select("_key", "hash").join(anchors, "hash").select("_key", "_class", "_view").distinct()
    met = hits.join(pairs, "_key").join(windows, ["_class", "_view", "hash"])
    stretch = F.floor((F.col("_pos") - F.col("_at")) / DRIFT)
    places = met.withColumn("_place", F.explode(F.array(stretch, stretch - 1)))
    matched = F.collect_set(F.struct("_at", "_pos")).alias("_matches")
    scored = places.groupBy("_key", "_class", "_view", "_place").agg(F.first("_n").alias("n_windows"), matched)
    scored = scored.withColumn("n_found", F.size(F.array_distinct("_matches._at")).cast("long"))
    scored = scored.where(F.col("n_found") >= F.ceil(F.col("n_windows") * coverage - 1e-9))
    best = scored.groupBy("_key", "_class", "_view", "n_windows").agg(
        F.max_by(F.struct("n_found", "_matches"), F.struct("n_found", "_place")).alias("_b")
    )
    found = saved(best.select("_key", "_class", "_view", "n_windows", "_b.*"), "matches")

    plain = found.where(F.col("_view") != TEMPLATE).join(members.drop("_all"), ["_class", "_view"])
    plain = saved(plain.select("_key", "_item", "n_windows", "n_found", F.lit(0).cast("long").alias("n_slots"), F.lit(True).alias("verbatim")), "plain_pairs")
    checked = _slots(found.where(F.col("_view") == TEMPLATE), docs, members, plain)
    share = (F.col("n_found") / F.col("n_windows")).alias("coverage")
    rows = plain.unionByName(checked).withColumn("n_windows", F.col("n_windows").cast("long"))
    fields = ["n_windows", "n_found", "n_slots", "verbatim"]
    rank = F.struct("verbatim", (F.col("n_found") / F.col("n_windows")).alias("_share"), "n_found", (-F.col("n_slots")).alias("_s"))
    rows = rows.groupBy("_key", "_item").agg(F.max_by(F.struct(*fields), rank).alias("_r")).select("_key", "_item", "_r.*")
    return rows.select(F.col("_key").alias(key), F.col("_item").alias(item), "n_windows", "n_found", share, "n_slots", "verbatim")


def _slots(found: DataFrame, docs: DataFrame, members: DataFrame, plain: DataFrame) -> DataFrame:
    """Template matches whose slot values correspond one to one, with the number of different pairs.

    Pairs that are among the ``plain`` ones are not looked at again.
    Documents are read again for these matches alone; Spark sends their keys to every executor
    if they are few and shuffles otherwise.
    """
    pairs = saved(found.join(members.drop("_all"), ["_class", "_view"]).join(plain, ["_key", "_item"], "left_anti"), "template_pairs")
    words = lambda c: F.split(valued(evened(F.col(c))), " ")
    rows = pairs.select("_key", "_item", "n_windows", "n_found", "_matches", words("_text").alias("_known"))
    texts = docs.join(pairs.select(F.col("_key").alias("_wanted")).distinct(), F.col("_key") == F.col("_wanted"), "left_semi")
    # Stored, so that the words are made once and not for every place that looks one up.
    rows = saved(rows.join(texts.distinct().select("_key", words("_text").alias("_given")), "_key"), "slot_words")

    def met(match: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(WINDOW - 1))
        at = F.transform(
            places,
            lambda k: F.struct(
                (match["_at"] + k).alias("at"),
                F.get("_known", match["_at"] + k).alias("known"),
                F.get("_given", match["_pos"] + k).alias("given"),
            ),
        )
        inside = (lambda s: (s["at"] > 0) & (s["at"] < F.size("_known") - 1) & F.substring(s["known"], 1, 1).rlike(MARKS))
        return F.transform(F.filter(at, inside), lambda s: F.struct(s["known"].alias("known"), s["given"].alias("given")))

    rows = rows.withColumn("_pairs", F.array_distinct(F.flatten(F.transform("_matches", met))))
    # Of several texts with one key, those without the windows have other signs in these places.
    alike = F.forall("_pairs", lambda p: F.coalesce(F.substring(p["known"], 1, 1) == F.substring(p["given"], 1, 1), F.lit(False)))
    count = F.size("_pairs")
    one_to_one = (count == F.size(F.array_distinct("_pairs.known"))) & (count == F.size(F.array_distinct("_pairs.given")))
    same = F.size(F.filter("_pairs", lambda p: p["known"] != p["given"])) == 0
    return rows.where(alike & one_to_one).select("_key", "_item", "n_windows", "n_found", count.cast("long").alias("n_slots"), same.alias("verbatim"))
