"""Personal data: patterns, and terms that reveal the person or device behind them.

The second part follows information theory. A protected entity is a distinct e-mail address, IP address, card or phone number, the group
it belongs to (mail domain, network, issuer, dialling prefix), or its kind. It carries -log2 p(entity) bits. A term near it gives
away log2 p(term, entity) / (p(term) p(entity)) of them, with probabilities estimated from document counts of the whole corpus. A
term that gives away at least ``generalise`` of an entity's bits becomes its class; at ``remove`` of them it goes.

Everything is DataFrame expressions. Matches and words are rows that know their text; running sums and extremes over a text's rows give
their places, their neighbours and the stretches that they cover, so that the work grows with the matches of a text, not with their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The four patterns. Possessive repeats and look-behinds leave their matches as they are and make the
# search linear: where a run of characters cannot start a match at its beginning, it cannot further on.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORD = r"\p{L}[\p{L}\p{M}]*+"

#: Characters on each side of an entity whose words count as co-occurring with it.
CONTEXT = 120
#: Documents that must hold a term beside an entity before their association is believed.
SUPPORT = 2
#: Shares of the entity's information.
GENERALISE, REMOVE = 0.8, 0.95
#: Rows (two short strings) up to which the disclosing pairs are broadcast; beyond, the join is shuffled.
BROADCAST_ROWS = 200_000

_SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(texts: DataFrame, found: Column) -> DataFrame:
    """(row, kind, start, end, value) of the matches of patterns, in code points.

    ``found`` makes of ``text`` an array of (kind, i, gap, n, value): match i of a kind, its length, and that of the text between it and the one before.
    """
    steps = texts.select("row", F.inline(found))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = steps.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto).cast("int"))
    return ended.select("row", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value")


def _steps(kind: str, text: Column, pattern: str, possible: Column) -> Column:
    """The matches of one pattern for ``matches``; none where a cheap test fails."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("value"))
    steps = F.transform(pairs, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["value"]).alias("n"), x["value"].alias("value")))
    return F.when(possible, steps).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,n:int,value:string>>"))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(number: Column) -> Column:
    n = F.length(number)

    def weigh(i: Column) -> Column:
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return (F.length(plain) <= 3) & (F.substring(plain, 1, 3).cast("int") <= 255)
        return F.forall(F.split(value, r"\."), small)
    number = digits(value)
    if kind == "card":
        return F.when(F.length(number).between(16, 19), _luhn(number)).otherwise(False)
    return F.length(number).between(8, 15)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that a text without matches fails."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][0-9 -]{14}[0-9]")


def _written(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"]))


def _entities(kind: Column, value: Column) -> Column:
    """What a match belongs to: itself, its group and its kind."""
    plain = F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(digits(value))
    group = F.when(kind == "email", F.substring_index(plain, "@", -1)).when(kind == "ip", F.substring_index(plain, ".", 3)) \
        .when(kind == "card", F.substring(plain, 1, 6)).otherwise(F.substring(plain, 1, 5))
    return F.array(F.concat(kind, F.lit(":"), plain), F.concat(kind, F.lit("~"), group), kind)


def _beside(private: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, start, end, term, entities): the words within CONTEXT characters after or before a match, with the nearest one on either side.

    Words that a match covers in part are no terms.
    """
    words = matches(private, _steps("word", F.col("text"), WORD, F.lit(True)))
    marks = spans.select("row", "start", "end", _entities(F.col("kind"), F.col("value")).alias("entities"))
    events = words.select("row", "start", "end", F.lower("value").alias("term"), F.lit(None).cast("array<string>").alias("entities")) \
        .unionByName(marks.withColumn("term", F.lit(None).cast("string")))
    match = F.col("entities").isNotNull()
    # Of equal starts the match comes first for the look back, and last for the look ahead: a word there is covered.
    back = Window.partitionBy("row").orderBy("start", F.col("entities").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("row").orderBy(F.desc("start"), F.col("entities").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = events.withColumn("before", F.max(F.when(match, F.struct("end", "entities"))).over(back)) \
        .withColumn("after", F.min(F.when(match, F.struct("start", "entities"))).over(ahead))
    after_match, before_match = F.col("start") - F.col("before.end"), F.col("after.start") - F.col("end")
    free = (F.coalesce(after_match, F.lit(0)) >= 0) & (F.coalesce(before_match, F.lit(0)) >= 0)
    none = F.array().cast("array<string>")
    near = lambda gap, side: F.when(gap <= CONTEXT, F.col(f"{side}.entities")).otherwise(none)
    both = F.concat(F.coalesce(near(after_match, "before"), none), F.coalesce(near(before_match, "after"), none))
    return seen.where(F.col("term").isNotNull() & free).select("row", "start", "end", "term", both.alias("entities")).where(F.size("entities") > 0)


def _sanitized(private: DataFrame, tags: DataFrame) -> DataFrame:
    """(row, sanitized): the texts, each stretch that tags cover replaced by the tag of the first of them."""
    upto = Window.partitionBy("row").orderBy("start", "end", "tag")
    reach = tags.withColumn("reach", F.max("end").over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    begins = reach.withColumn("k", F.sum(F.when(F.col("reach").isNull() | (F.col("start") >= F.col("reach")), 1).otherwise(0)).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = begins.groupBy("row", "k").agg(F.min(F.struct("start", "end", "tag")).alias("first"), F.max("end").alias("end"))
    cuts = stretches.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("first.start").alias("start"), "end", F.col("first.tag").alias("tag")))).alias("cuts"))
    text = F.col("text")

    def piece(x: Column, i: Column) -> Column:
        start = F.when(i > 0, F.get("cuts", i - 1)["end"]).otherwise(0)
        return F.concat(F.substring(text, start + 1, x["start"] - start), x["tag"])

    rest = F.substring(text, F.element_at("cuts", -1)["end"] + 1, F.length(text))
    return private.join(cuts, "row").select("row", F.concat(F.array_join(F.transform("cuts", piece), ""), rest).alias("sanitized"))


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                       generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Personal data in every whole text, and the text without it.

    Returns ``id_col``, ``text_hash`` long, ``email``, ``ip``, ``card``, ``phone`` and ``term`` (arrays of (start, end, value) in code
    points, sorted), and ``sanitized`` string: null where nothing was found, so the text stands. One row per input row; null and
    empty texts have no spans. Repeated rows count as documents each and get the same spans. Other columns are ignored.
    Base spans of different kinds may overlap; each is reported, and ``sanitized`` replaces what they cover once.

    Shuffles: matches, and the words of texts that have some, by text; counts of words and of (term, entity) pairs, both combined in each
    task first. A hot entity or word is a count; what one task holds together is one text's matches and words. Only texts that may have
    matches are stored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    some = _possible(KINDS[0], text)
    for k in KINDS[1:]:
        some = some | _possible(k, text)
    found = stored(rows.select("id", F.xxhash64("text").alias("text_hash"), F.when(some, text).alias("text"), F.monotonically_increasing_id().alias("row")))
    candidates = found.where("text is not null").select("row", "text")
    valid = F.lit(False)
    for k in KINDS:
        valid = F.when(F.col("kind") == k, _valid(k, F.col("value"))).otherwise(valid)
    spans = stored(matches(candidates, F.concat(*(_steps(k, text, PATTERNS[k], _possible(k, text)) for k in KINDS))).where(valid))
    private = candidates.join(spans.select("row").distinct(), "row", "left_semi")
    near = stored(_beside(private, spans))

    total = rows.count()
    entity = F.explode(_entities(F.col("kind"), F.col("value"))).alias("entity")
    by_entity = spans.select("row", entity).distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = near.select("row", "term", F.explode("entities").alias("entity"))
    by_pair = pairs.distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    by_pair = stored(by_pair.join(by_entity, "entity"))
    asked = stored(by_pair.select("term").distinct())
    if asked.count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    words = rows.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{M}]+"))).alias("term"))
    by_term = words.join(asked, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    bits = F.log2(F.lit(float(total)) / F.col("n_entity"))
    told = F.log2(F.col("n_both") * F.lit(float(total)) / (F.greatest("n_term", "n_both") * F.col("n_entity")))
    disclosing = by_pair.join(by_term, "term").where(bits > 0).withColumn("share", told / bits).where(F.col("share") >= generalise)
    disclosing = stored(disclosing.select("entity", "term", "share"))
    if disclosing.count() <= BROADCAST_ROWS:
        disclosing = F.broadcast(disclosing)
    hits = stored(near.select("row", "start", "end", "term", F.explode("entities").alias("entity")).join(disclosing, ["entity", "term"])
                  .groupBy("row", "start", "end", "term").agg(F.max("share").alias("share")))

    base_tags = spans.select("row", "start", "end", F.concat(F.lit("["), F.upper("kind"), F.lit("]")).alias("tag"))
    term_tags = hits.select("row", "start", "end", F.when(F.col("share") >= remove, "").otherwise("[TERM]").alias("tag"))
    clean = _sanitized(private, base_tags.unionByName(term_tags))
    every = spans.unionByName(hits.select("row", F.lit(TERM).alias("kind"), "start", "end", F.col("term").alias("value")))
    of_kind = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("start", "end", "value"))))
    per_row = every.groupBy("row").agg(*(of_kind(k).alias(k) for k in (*KINDS, TERM))).join(clean, "row")
    none = F.array().cast(_SPAN)
    result = found.select("id", "text_hash", "row").join(per_row, "row", "left")
    return result.select(F.col("id").alias(id_col), "text_hash", *(F.coalesce(k, none).alias(k) for k in (*KINDS, TERM)), "sanitized")


def written(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the columns of ``find_personal_data``, comma-joined."""
    return F.array_join(F.concat(*(_written(F.col(k), k) for k in kinds)), ",")
