"""Near-duplicate lines by a deletion-neighbourhood join; native operators only.

The unit of an edit is a word: two lines are near when one word inserted, deleted or
replaced turns one into the other, and that word is at most a quarter of the longer line
(which so has ``LONGER`` words or more). Of lines that are equal or near, the earliest stays;
lines stand in the order of (doc_id, line number). A line goes if any earlier line is
equal or near, whether or not that one stays. Lines of white space only always stay.

1. Lines become 128-bit hashes and equal lines combine.
2. Near lines agree in the half that the edit spares, so lines whose halves all occur
   once cannot have a neighbour. The others are candidates; a line of n words has
   halves of n/2 and (n-1)/2 words, which lines one word longer or shorter share.
3. Candidates emit the line itself and its variants with one word deleted. Hashes are sums
   (by exclusive or) over words and their places, so running sums over the words of a
   line give each variant in constant time, however long the line is.
4. Equal variants join: variants with the same place differ by that word; a whole line equal
   to a variant lacks that word. Variants that occur once are left out by their counts
   first. Each bucket is an aggregate that keeps its earliest line, so a bucket of any
   size costs one row per member and no pairs are made.
5. The earliest partner's words verify the distance.

Null texts have no lines. Null doc_ids come first. Rows that repeat doc_id and text are
one document. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.llm.text import NULL_ID, row_key
from upcharts.session import materialise

#: words of the longer of two near lines, at least
LONGER = 4

_KEY = ["_id", "_check"]
_PLACE = [*_KEY, "line_no"]
_BLANK = " \t\x0b\x0c\r"


def _words(line: str) -> Column:
    return F.split(line, " ")


def _hash_pair(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes of the same values."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank, with its place and text."""
    exploded = docs.select(*row_key(), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return exploded.where(F.trim("line", F.lit(_BLANK)) != "")


def _half_keys() -> Column:
    """Hashes of the halves of ``line`` that an edit may spare, both from the front and from the back."""
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    sizes = [(n / 2).cast("int"), ((n - 1) / 2).cast("int")]
    part = lambda count: F.call_function("substring_index", F.col("line"), F.lit(" "), count)
    keys = [F.xxhash64(F.lit(side), h, part(h if side == "front" else -h)) for h in sizes for side in ("front", "back")]
    # an odd line has halves of one size only
    own = F.when(n % 2 == 1, F.array(*keys[:2])).otherwise(F.array(*keys))
    return F.when(n >= LONGER - 1, own).otherwise(F.array().cast("array<long>"))


def _variants(candidates: DataFrame) -> DataFrame:
    """Two hashes of each candidate line (place -1) and of it without one word."""
    n = F.size("words")
    closed = F.concat("words", F.array(F.lit(None).cast("string")))
    # a line's words stay in the task that its row was sent to
    spread = candidates.repartition(*_PLACE).select(*_PLACE, n.alias("n"), F.posexplode(closed).alias("at", "word"))
    line = Window.partitionBy(*_PLACE).orderBy("at")
    ahead, upto = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, 0)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    real = F.col("word").isNotNull()
    keys = []
    for seed, name in enumerate(("one", "two")):
        # a word behind the deleted one moves up by one place
        here = F.when(real, F.xxhash64(F.lit(seed), F.col("at"), F.col("word"))).otherwise(F.lit(0).cast("long"))
        moved = F.when(real, F.xxhash64(F.lit(seed), F.col("at") - 1, F.col("word"))).otherwise(F.lit(0).cast("long"))
        front = F.coalesce(F.bit_xor(here).over(ahead), F.lit(0).cast("long"))
        behind = F.bit_xor(moved).over(whole).bitwiseXOR(F.bit_xor(moved).over(upto))
        keys.append(front.bitwiseXOR(behind).alias(name))
    # without the closing mark, the line itself
    at = F.when(real, F.col("at")).otherwise(-1).alias("at")
    return spread.select(*_PLACE, "n", at, *keys).where(f"n >= {LONGER} OR at < 0").drop("n")


def within_one_word(a: Column, b: Column) -> Column:
    """Whether word lists ``a`` and ``b`` are at most one word edit apart."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    wrong = F.array_position(same, F.lit(False))  # from 1; 0 if one begins with the other
    n, m = F.size(a), F.size(b)
    at = F.when(wrong == 0, F.least(n, m) + 1).otherwise(wrong).cast("int")
    rest = lambda c, skip: F.slice(c, at + skip, F.size(c))
    skip_a, skip_b = (n >= m).cast("int"), (m >= n).cast("int")
    return (F.abs(n - m) <= 1) & (rest(a, skip_a) == rest(b, skip_b))


def _earliest_near(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """For each distinct line with an earlier near line: first (its place) and near, the earliest of them."""
    keys = distinct.select("h", "g", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    chosen = keys.join(shared, "key", "left_semi").select("h", "g").distinct()
    places = distinct.join(chosen, ["h", "g"]).select("first._id", "first._check", "first.line_no")
    by_doc = places.groupBy(*_KEY).agg(F.collect_list("line_no").alias("wanted"))
    texts = docs.select(*row_key(), "text").join(by_doc, _KEY).dropDuplicates(_KEY)
    candidates = materialise(
        texts.select(*_KEY, F.split("text", "\n").alias("lines"), F.explode("wanted").alias("line_no")).select(
            *_PLACE, _words(F.element_at("lines", F.col("line_no") + 1)).alias("words")
        ),
        "line_candidates",
    )
    variants = materialise(_variants(candidates), "line_variants")
    # what occurs once has no partner; the counts combine before they are shuffled
    repeated = variants.groupBy("one").agg(F.count("*").alias("n")).where("n > 1").select("one")
    meeting = materialise(variants.join(repeated, "one", "left_semi").select("one", "two", "at", F.struct(*_PLACE).alias("first")), "meeting_variants")

    cut = F.col("at") >= 0
    same_place = meeting.groupBy("one", "two", "at").agg(F.min("first").alias("near"), F.count("*").alias("n"))
    same_place = materialise(same_place, "variant_places")
    lengths = same_place.groupBy("one", "two").agg(F.min(F.when(~cut, F.col("near"))).alias("whole"), F.min(F.when(cut, F.col("near"))).alias("cut"))
    # a cut line meets those cut at the same place and the whole one, a whole line the cut ones
    partners = same_place.join(lengths, ["one", "two"])
    earliest = F.when(cut, F.least(F.when(F.col("n") > 1, F.col("near")), "whole")).otherwise(F.col("cut"))
    partners = partners.select("one", "two", "at", earliest.alias("near")).where("near is not null")
    found = meeting.join(partners, ["one", "two", "at"]).where("near < first").groupBy("first").agg(F.min("near").alias("near"))

    placed = candidates.select(F.struct(*_PLACE).alias("first"), "words")
    partner = placed.select(F.col("first").alias("near"), F.col("words").alias("near_words"))
    checked = found.join(placed, "first").join(partner, "near")
    return checked.where(within_one_word(F.col("words"), F.col("near_words"))).select("first", "near")


def removed_lines(docs: DataFrame) -> DataFrame:
    """One row per line that goes: _id, _check, line_no and ``keep``, the earliest equal or near line."""
    h, g = _hash_pair(F.col("line"))
    lines = materialise(_lines(docs).select(*_PLACE, h.alias("h"), g.alias("g"), _half_keys().alias("keys")), "lines")
    place = F.struct(*_PLACE)
    distinct = materialise(
        lines.groupBy("h", "g").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys")),
        "distinct_lines",
    )
    near = _earliest_near(distinct, docs)
    keep = distinct.select("h", "g", "first", "n").join(near, "first", "left").where("n > 1 or near is not null")
    keep = keep.select("h", "g", F.coalesce("near", "first").alias("keep"))
    return lines.select(*_PLACE, "h", "g").join(keep, ["h", "g"]).where(place != F.col("keep")).select(*_PLACE, "keep")


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed_lines, kept_from.

    ``removed_lines`` lists the numbers (from 0) of the lines that go, and ``kept_from``
    the documents that hold the line kept in place of each, both joined by commas.
    """
    gone = removed_lines(docs).groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.struct("line_no", F.col("keep._id").alias("of")))).alias("gone"))
    counted = docs.select(F.col("doc_id").alias("doc_id"), *row_key(), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    of = lambda x: F.coalesce(F.nullif(x["of"], F.lit(NULL_ID)).cast("string"), F.lit("null"))
    return counted.join(gone, _KEY, "left").select(
        "doc_id",
        F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join(F.transform("gone", lambda x: x["line_no"].cast("string")), ","), F.lit("")).alias("removed_lines"),
        F.coalesce(F.array_join(F.transform("gone", of), ","), F.lit("")).alias("kept_from"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go taken out of text; a null text stays null."""
    gone = removed_lines(docs).groupBy(*_KEY).agg(F.collect_set("line_no").alias("gone"))
    # the rows stand in a struct of their own, so that none of their columns can clash
    rows = docs.select(F.struct("*").alias("row"), *row_key()).join(gone, _KEY, "left")
    kept = F.filter(F.split("row.text", "\n"), lambda line, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")
