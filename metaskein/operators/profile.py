"""Column profiles, discovery of keys in JSON columns, and enrichment with statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import cut


def null_percentages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(item, null_percentage) of every column, from one pass over the table."""
    columns = columns or df.columns
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return _rows_of(shares, columns, "null_percentage")


def _rows_of(one_row: DataFrame, columns: list[str], value: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias(value)) for c in columns])
    return one_row.select(F.inline(entries))


#: Values of a column that a sketch follows at a time, and the most frequent of them that are counted exactly.
TRACKED, CANDIDATES = 10_000, 64


def most_common_values(df: DataFrame, columns: list[str] | None = None, *, tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(item, most_common_value, frequency): exact; the smallest value wins a tie.

    Columns whose values are all distinct have NULL, like columns without values.

    A sketch of a column's value hashes, merged over all tasks, names candidates and bounds the count of every other value. The candidates
    are counted exactly, and where the best of them is above the bound it has won: nothing was shuffled but sketches and
    candidates. Only columns without such a value are counted in full, by a 128-bit hash of 16 bytes for each value and
    not by its text, and the text of the values with the highest count is looked up at the end.
    """
    columns = columns or df.columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])

    def entries(*seeds: int) -> DataFrame:
        """(item, value, h0, …) of all values that are not NULL."""
        hashed = [F.xxhash64(F.lit(s), F.col("value")).alias(f"h{s}") for s in seeds]
        one = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in columns])
        return texts.select(F.inline(one)).where(F.col("value").isNotNull()).select("*", *hashed)

    def winner(values: DataFrame) -> DataFrame:
        """Of (item, value) rows the most frequent value of each item that occurs twice at least."""
        counts = values.groupBy("item", "value").agg(F.count("*").alias("n"))
        return counts.where("n > 1").groupBy("item").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))

    top = lambda c: F.call_function("approx_top_k", F.xxhash64(F.lit(0), F.col(c)), F.lit(candidates), F.lit(tracked))
    # NULL hashes to a value like others; it only takes a place in the sketch.
    sketch = texts.agg(F.count("*").alias("n"), *[top(c).alias(f"top_{k}") for k, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("item"), F.col(f"top_{k}").alias("top"), F.col("n")) for k, c in enumerate(columns)])
    # A value that the sketch does not list has at most twice its largest error, 2.625 / tracked of all, or no more than the last one listed.
    least = F.when(F.size("top") == candidates, F.array_min(F.transform("top", lambda x: x["count"]))).otherwise(0)
    bound = F.greatest(F.col("n") * (2 * 2.625 / tracked), least.cast("double"))
    listed = cut(sketch.select(F.inline(rows)).select("item", F.transform("top", lambda x: x["item"]).alias("hashes"), bound.alias("bound")))  # one row a column

    wanted = F.broadcast(listed.select("item", F.explode("hashes").alias("h0")))
    heavy = winner(entries(0).join(wanted, ["item", "h0"], "left_semi")).join(F.broadcast(listed.select("item", "bound")), "item")
    sure = cut(heavy.where(-F.col("best.n") > F.col("bound")).select("item", "best"))

    open_items = F.broadcast(listed.join(F.broadcast(sure), "item", "left_anti").select("item"))
    every = entries(1, 2).join(open_items, "item", "left_semi")
    by_hash = every.groupBy("item", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    most = by_hash.groupBy("item").agg(F.max("n").alias("n"))
    tied = by_hash.join(F.broadcast(most), ["item", "n"]).select("item", "h1", "h2")
    rest = winner(every.join(tied, ["item", "h1", "h2"], "left_semi"))

    items = df.sparkSession.createDataFrame([(c,) for c in columns], "item string")
    return items.join(F.broadcast(sure.unionByName(rest)), "item", "left").select(
        "item", F.col("best.value").alias("most_common_value"), (-F.col("best.n")).alias("frequency"))


def profile_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(item, null_percentage, most_common_value): one row per column of the table."""
    common = most_common_values(df, columns).select("item", "most_common_value")
    return null_percentages(df, columns).join(F.broadcast(common), "item")


def stats_from_catalog(stats: DataFrame) -> DataFrame:
    """Profile rows out of the database's own planner statistics."""
    return stats.select(
        F.col("schemaname").alias("schema"), F.col("tablename").alias("dataset_id"),
        F.col("attname").alias("item"), (F.col("null_frac") * 100).alias("null_percentage"),
        F.get("most_common_vals", F.lit(0)).alias("most_common_value"))


def enrich_with_stats(items: DataFrame, stats: DataFrame) -> DataFrame:
    """Items with their statistics; names are compared without case.

    A matched item gets ``most_common_value`` (text 'NULL' when there is none) and
    ``null_percentage``; its example becomes the most common value if that exists.
    Statistics must be unique per (schema, dataset_id, item).
    """
    s = stats.select(
        F.lower("schema").alias("_schema"), F.lower("dataset_id").alias("_set"), F.lower("item").alias("_item"),
        F.col("null_percentage"), F.col("most_common_value").alias("_value"), F.lit(True).alias("_hit"))
    out = items.join(
        s, (F.lower("schema") == F.col("_schema")) & (F.lower("dataset_id") == F.col("_set"))
        & (F.lower("physical_nm") == F.col("_item")), "left")
    return out.withColumn("example", F.coalesce("_value", "example") if "example" in items.columns
                          else F.col("_value")).withColumn(
        "most_common_value", F.when(F.col("_hit"), F.coalesce("_value", F.lit("NULL")))
    ).drop("_schema", "_set", "_item", "_value", "_hit")


# --- keys in JSON columns ----------------------------------------------------


def json_items(items: DataFrame, sets: DataFrame, *, skip_views: bool = False,
               fields: list[str] | None = None) -> DataFrame:
    """JSON columns to expand: types json and jsonb, all or the listed full names."""
    wanted = items.where(F.lower("type").isin("json", "jsonb"))
    if skip_views:
        views = sets.where(X.is_view("type")).select("schema", F.col("physical_nm").alias("dataset_id"))
        wanted = wanted.join(views, ["schema", "dataset_id"], "left_anti")
    if fields and "*" not in fields:
        wanted = wanted.where(F.lower("fqdn").isin(*fields))
    return wanted


def json_keys(df: DataFrame, columns: list[str], *, mode: str = "full") -> DataFrame:
    """Distinct (source, attribute): top-level keys of the JSON objects in the columns.

    One scan serves all columns. ``full`` looks at every row. ``compat`` takes the keys
    of one row per column only: the row with the greatest key, and of several such
    rows the one with the greatest text. Arrays, scalars and malformed text have no keys.
    """
    entries = F.array(*[
        F.struct(F.lit(c).alias("source"), F.col(c).alias("text"), F.json_object_keys(c).alias("keys"))
        for c in columns])
    objects = df.select(F.explode(entries).alias("e")).select("e.*").where(F.col("keys").isNotNull())
    if mode == "compat":
        rank = F.struct(F.array_max("keys").alias("k"), "text")
        objects = objects.groupBy("source").agg(F.max_by("keys", rank).alias("keys"))
    elif mode != "full":
        raise ValueError(f"unknown mode {mode!r}: use 'full' or 'compat'")
    return objects.select("source", F.explode("keys").alias("attribute")).distinct()


def expand_json_columns(
    df: DataFrame, columns: list[str], set_nm: str, set_fqdn: str, *, mode: str = "full"
) -> DataFrame:
    """New item rows, one per key of each JSON column: ``column::key`` of type text.

    The full name holds the key only, so equal keys of two JSON columns of a set share it.
    """
    return json_keys(df, columns, mode=mode).select(
        F.lit(set_nm).alias("dataset_id"),
        F.concat("source", F.lit("::"), "attribute").alias("physical_nm"),
        F.lit("text").alias("type"),
        F.lit(False).alias("identity"),
        F.lit(True).alias("nullable"),
        F.concat(F.lit(f"{set_fqdn}."), "attribute").alias("fqdn"),
        F.to_json(F.struct("source")).alias("metadata"),
    )


# The name's ending, the type and the comment of the key that marks a JSON column as expanded.
def json_expansion_key(set_nm: str) -> dict[str, str]:
    """The key that marks a JSON column as expanded."""
    return {
        "name": f"{set_nm.lower()}_json_expansion_key",
        "type": "json",
        "comment": f"Generated by JSON autoexpansion of the {set_nm} item.",
    }


def place_of(path: Column) -> Column:
    """The folder of a table out of the path of one of its files, without partition folders; local paths without their scheme."""
    return F.regexp_replace(_local(path), "(/[^/=]+=[^/]*)*/[^/]+$", "")


def _local(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "(?<=[^/])/+$", "")


def _scans(wanted: list[tuple[str, str]], others: list[tuple[str, str]]) -> list[tuple[list[str], list[str]]]:
    """(paths, columns) of as few scans as possible: in one, a name is a JSON column in every table that has it.

    ``wanted`` and ``others`` are (path, column) pairs of JSON columns, and of other columns that have the name of some JSON column.
    """
    tables: dict[str, tuple[set[str], set[str]]] = {}
    for k, pairs in enumerate((wanted, others)):
        for path, column in pairs:
            tables.setdefault(path, (set(), set()))[k].add(column)
    scans: list[tuple[list[str], set[str], set[str]]] = []
    for path, (mine, not_mine) in sorted(tables.items()):
        low = {c.lower(): c for c in mine}
        away = {c.lower() for c in not_mine}
        for paths, columns, avoid in scans:
            # Names that differ in case only would be one column of a scan.
            same = all(low.get(c.lower(), c) == c for c in columns)
            if same and not away & {c.lower() for c in columns} and not avoid & low.keys():
                paths.append(path)
                columns |= mine
                avoid |= away
                break
        else:
            scans.append(([path], set(mine), set(away)))
    return [(paths, sorted(columns)) for paths, columns, _ in scans]


def expand_json_tables(items: DataFrame, sets: DataFrame, places: DataFrame, *, skip_views: bool = False,
                       fields: list[str] | None = None, mode: str = "full") -> DataFrame:
    """New item rows for the keys of all wanted JSON columns of all stored tables, from one scan.

    ``places`` has ``schema``, ``dataset_id`` and ``path``: the folder or file of Parquet data of a table. All tables with
    JSON columns are read by one scan over their paths, and a file's path tells whose row it is; so the plan does not grow
    with the number of tables. A second scan is needed only where a name is a JSON column in one table and has another type in another.
    Tables without a place are not expanded. ``fields``, ``skip_views`` and ``mode`` are those of ``json_items`` and ``json_keys``.

    Returns schema, dataset_id, source (the JSON column) and the item columns of ``expand_json_columns``. Only names reach the driver.
    Keys are made distinct in each task; one shuffle of (table, column, key), in ``compat`` mode of one text for each column and task.
    """
    spark = items.sparkSession
    here = places.select("schema", "dataset_id", _local(F.col("path")).alias("place"), "path")
    wanted = json_items(items, sets, skip_views=skip_views, fields=fields).select("schema", "dataset_id", "physical_nm").distinct() \
        .join(here, ["schema", "dataset_id"])
    names = F.broadcast(wanted.select(F.lower("physical_nm").alias("_name")).distinct())
    typed = items.where(~F.coalesce(F.lower("type").isin("json", "jsonb"), F.lit(False))).withColumn("_name", F.lower("physical_nm"))
    others = typed.join(names, "_name", "left_semi").select("schema", "dataset_id", "physical_nm").join(wanted.select("schema", "dataset_id", "path").distinct(), ["schema", "dataset_id"])
    pairs = lambda df: [(r.path, r.physical_nm) for r in df.select("path", "physical_nm").distinct().collect()]
    found = spark.createDataFrame([], "place string, source string, attribute string")
    for paths, columns in _scans(pairs(wanted), pairs(others)):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        file = F.col("_metadata.file_path")
        single = [p for p in paths if "." in p.rsplit("/", 1)[-1]]  # such a path may be one file
        alone = _local(file).isin([r[0] for r in spark.createDataFrame([(p,) for p in single], "p string").select(_local(F.col("p"))).collect()]) if single else F.lit(False)
        rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths).select("*", F.when(alone, _local(file)).otherwise(place_of(file)).alias("_place"))
        entries = F.array(*[F.struct(F.lit(c).alias("source"), F.col(f"`{c}`").alias("text"), F.json_object_keys(F.col(f"`{c}`")).alias("keys")) for c in columns])
        objects = rows.select(F.col("_place").alias("place"), F.inline(entries)).where(F.col("keys").isNotNull())
        if mode == "compat":
            rank = F.struct(F.array_max("keys").alias("k"), "text")
            objects = objects.groupBy("place", "source").agg(F.max_by("keys", rank).alias("keys"))
        elif mode != "full":
            raise ValueError(f"unknown mode {mode!r}: use 'full' or 'compat'")
        found = found.unionByName(objects.select("place", "source", F.explode("keys").alias("attribute")).distinct())
    of_set = wanted.select("schema", "dataset_id", F.col("physical_nm").alias("source"), "place")
    return found.join(of_set, ["place", "source"]).select(
        "schema", "dataset_id", "source",
        F.concat("source", F.lit("::"), "attribute").alias("physical_nm"), F.lit("text").alias("type"), F.lit(False).alias("identity"),
        F.lit(True).alias("nullable"), X.fqdn("schema", "dataset_id", "attribute").alias("fqdn"), F.to_json(F.struct("source")).alias("metadata"))


def expansion_keys(expanded: DataFrame) -> DataFrame:
    """The keys that mark JSON columns as expanded, one row for each such column: dataset_id, name, type, comment, item.

    They have the form that ``document.merge_keys`` takes. A column without any key is not marked.
    """
    made = {k: json_expansion_key("@")[k] for k in ("name", "type", "comment")}
    named = lambda k, c: F.concat(*[x for p in made[k].split("@") for x in (F.lit(p), c)][:-1])
    return expanded.select("schema", "dataset_id", "source").distinct().select(
        "schema", "dataset_id", named("name", F.lower("dataset_id")).alias("name"), F.lit(made["type"]).alias("type"),
        named("comment", F.col("dataset_id")).alias("comment"), F.col("source").alias("item"))
