"""One query per operator, over the test tables as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.functions import (
    code_to_label,
    contains_any,
    has_prefix,
    leading_int,
    repair_text,
    strip_code,
    to_int,
)
from comarca.operators import (
    Traced,
    attributes_long,
    attributes_wide,
    audit_filters,
    bucket_sums,
    canonicalise,
    count_by,
    count_matrix,
    dedup,
    derive_dimension,
    distinct_values,
    drop_sentinel,
    explode_delimited,
    explode_elements,
    fill_from_lookup,
    find_dupes,
    find_long_dupes,
    null_counts,
    pivot_first,
    profile,
    profile_sketch,
    rate_per,
    stats,
    top_k,
    unique_lookup,
    value_pairs,
    value_sets,
    value_sets_up_to,
)
from comarca.plans.run import staged
from comarca.queries.registry import profile_sql, query, table
from comarca.sources import (
    ATTRIBUTE_DOCUMENT,
    ATTRIBUTE_PATH,
    SLOTS,
    ingest_tagged,
    read_delimited,
    read_documents,
    read_partitioned,
    scratch_path,
    write_delimited,
    write_partitioned,
)

# Sources and sinks -------------------------------------------------------------------


@query("""
    SELECT DISTINCT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
           'customer' AS kind
    FROM customer
    UNION ALL
    SELECT DISTINCT s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
""")
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def columns(prefix: str) -> dict:
        return {name: F.col(prefix + name) for name in ("name", "nationkey", "acctbal")}

    return ingest_tagged(
        [
            (table(spark, sf_dir, "customer"), columns("c_"), "customer"),
            (table(spark, sf_dir, "supplier"), columns("s_"), "supplier"),
        ],
        "kind",
    )


@query("""
    SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS code,
           p_name || ' "' || p_brand || '"; ' || p_type AS label,
           CASE WHEN p_size > 10 THEN p_type END AS kind,
           'part' AS source
    FROM part
""")
def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts through delimited text: dotted header, padded code, quotes, separators, nulls."""
    written = table(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("Part.Code"),
        F.concat("p_name", F.lit(' "'), "p_brand", F.lit('"; '), "p_type").alias("Label"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("Kind"),
    )
    path = scratch_path(spark, "delimited")
    write_delimited(written, path)
    columns = {"code": F.col("`Part.Code`"), "label": F.col("Label"), "kind": F.col("Kind")}
    return read_delimited(spark, path).select(
        *[column.alias(name) for name, column in columns.items()], F.lit("part").alias("source")
    )


def _part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a document of two elements: what it is and what it costs.

    The second element repeats an attribute and leaves one without a value. Values sit in
    different slots.
    """

    def attribute(name: str, slot: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            *[
                (value if other == slot else F.lit(None).cast("string")).alias(other)
                for other in SLOTS
            ],
        )

    price = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    no_value = F.lit(None).cast("string")
    what = F.array(
        attribute("name", "string", F.col("p_name")),
        attribute("brand", "LocalidadPadre", F.col("p_brand")),
        attribute("type", "valor", F.col("p_type")),
    )
    cost = F.array(
        attribute("price", "text", price),
        attribute("size", "valor", F.col("p_size").cast("string")),
        attribute("size", "string", F.lpad(F.col("p_size").cast("string"), 3, "0")),
        attribute("stock", "valor", no_value),
    )
    elements = F.array(
        F.struct(F.struct(what.alias("attribute")).alias("element")),
        F.struct(F.struct(cost.alias("attribute")).alias("element")),
    )
    document = F.struct(F.col("p_partkey").cast("string").alias("date"), elements.alias("list"))
    return table(spark, sf_dir, "part").select(document.alias("document"))


_PART_ATTRIBUTES = """
    SELECT p_partkey, 0 AS element_id, 'name' AS name, NULL AS valor,
           NULL AS LocalidadPadre, p_name AS string, NULL AS text FROM part
    UNION ALL SELECT p_partkey, 0, 'brand', NULL, p_brand, NULL, NULL FROM part
    UNION ALL SELECT p_partkey, 0, 'type', p_type, NULL, NULL, NULL FROM part
    UNION ALL SELECT p_partkey, 1, 'price', NULL, NULL, NULL,
                     CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 1, 'size', CAST(p_size AS VARCHAR), NULL, NULL, NULL FROM part
    UNION ALL SELECT p_partkey, 1, 'size', NULL, NULL,
                     lpad(CAST(p_size AS VARCHAR), 3, '0'), NULL FROM part
    UNION ALL SELECT p_partkey, 1, 'stock', NULL, NULL, NULL, NULL FROM part
"""


@query(f"""
    SELECT CAST(p_partkey AS VARCHAR) AS document_id, element_id, name, valor,
           LocalidadPadre AS parent, string, text
    FROM ({_PART_ATTRIBUTES})
""")
def attributes_long_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _part_documents(spark, sf_dir).withColumn("document_id", F.col("document.date"))
    long = attributes_long(documents, ATTRIBUTE_PATH, ["document_id"], SLOTS)
    return long.withColumnRenamed("LocalidadPadre", "parent")


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS document_id, 0 AS element_id, p_name AS name,
           p_brand AS brand, CAST(NULL AS VARCHAR) AS size,
           CAST(NULL AS VARCHAR) AS stock, CAST(NULL AS VARCHAR) AS colour
    FROM part
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), 1, NULL, NULL,
           least(CAST(p_size AS VARCHAR), lpad(CAST(p_size AS VARCHAR), 3, '0')), NULL, NULL
    FROM part
""")
def attributes_wide_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute lists to columns: repeated, valueless and unknown attributes included."""
    documents = _part_documents(spark, sf_dir).withColumn("document_id", F.col("document.date"))
    elements = explode_elements(documents, ATTRIBUTE_PATH, ["document_id"])
    return attributes_wide(elements, "attributes", ["name", "brand", "size", "stock", "colour"], SLOTS)


@query(f"""
    SELECT CAST(p_partkey AS VARCHAR) AS document_id, element_id, name,
           coalesce(valor, LocalidadPadre, string, text) AS value
    FROM ({_PART_ATTRIBUTES})
""")
def document_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts through JSON documents on disk, one per line, and back to attributes."""
    path = scratch_path(spark, "documents")
    _part_documents(spark, sf_dir).write.json(path)
    documents = read_documents(spark, path, ATTRIBUTE_DOCUMENT, whole_file=False)
    named = documents.withColumn("document_id", F.col("document.date"))
    long = attributes_long(named, ATTRIBUTE_PATH, ["document_id"], SLOTS)
    value = F.coalesce(*SLOTS).alias("value")
    return long.select("document_id", "element_id", "name", value)


@query("""
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS nation, c_mktsegment AS segment,
           count(*) AS customers, max(c_custkey) AS last_customer
    FROM customer GROUP BY 1, 2
""")
def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through a table partitioned by a zero-padded text key."""
    keyed = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("nation")
    )
    path = scratch_path(spark, "partitions")
    write_partitioned(keyed, path, ["nation"])
    stored = read_partitioned(spark, path, "c_custkey long, c_mktsegment string, nation string")
    return stored.groupBy("nation", F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.max("c_custkey").alias("last_customer")
    )


@query("""
    SELECT event_type, count(*) AS events, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k
    FROM events GROUP BY event_type
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select(
        "event_type", F.from_json("props", "k long").alias("document")
    )
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("document.k").alias("k")
    )


# Checks and repairs ------------------------------------------------------------------


@query("""
    SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count
    FROM orders
    UNION ALL
    SELECT 'status', count(*) FILTER (WHERE o_orderpriority = '1-URGENT') FROM orders
    UNION ALL
    SELECT 'price', count(*) FILTER (WHERE o_totalprice < 100000) FROM orders
""")
def null_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_with_gaps(spark, sf_dir).withColumn(
        "price", F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice"))
    )
    return null_counts(orders, ["o_orderkey", "status", "price"])


def _orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is unknown when urgent."""
    known = F.col("o_orderpriority") != "1-URGENT"
    return table(spark, sf_dir, "orders").withColumn("status", F.when(known, F.col("o_orderstatus")))


@query("""
    SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS "count"
    FROM orders GROUP BY ALL HAVING count(*) > 1
""")
def find_dupes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return find_dupes(orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS "count"
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def find_dupes_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_dupes(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT text, count(*) AS "count" FROM documents GROUP BY text HAVING count(*) > 1
""")
def find_dupe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_long_dupes(table(spark, sf_dir, "documents"), "text")


@query("""
    SELECT o_custkey, status, o_orderpriority, o_orderkey, o_totalprice
    FROM (
        SELECT o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS status,
               o_orderpriority, o_orderkey, o_totalprice
        FROM orders
    )
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey, status, o_orderpriority ORDER BY o_orderkey, o_totalprice
    ) = 1
""")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per customer, status and priority, the first by key; null statuses are equal."""
    orders = _orders_with_gaps(spark, sf_dir).select(
        "o_custkey", "status", "o_orderpriority", "o_orderkey", "o_totalprice"
    )
    return dedup(orders, ["o_custkey", "status", "o_orderpriority"], ["o_orderkey"])


@query("""
    SELECT event_id, kind FROM (
        SELECT event_id, CASE WHEN value >= 10 THEN event_type END AS kind FROM events
    ) WHERE kind <> 'error'
""")
def drop_sentinel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("value") >= 10, F.col("event_type")).alias("kind")
    events = table(spark, sf_dir, "events").select("event_id", kind)
    return drop_sentinel(events, "kind", ["error"])


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def sentinel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type") == "error").select("event_id", "user_id", "value")


@query("""
    SELECT c_custkey, segment FROM (
        SELECT c_custkey,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'machines'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'cars'
                    WHEN c_acctbal >= 0 THEN lower(c_mktsegment) END AS segment
        FROM customer
    ) WHERE segment IN ('machines', 'cars', 'building')
""")
def canonicalise_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = (F.col("c_acctbal") >= 0) | F.col("c_mktsegment").isin("MACHINERY", "AUTOMOBILE")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(known, F.col("c_mktsegment")).alias("segment")
    )
    fixes = {"machinery": "machines", "automobile": "cars"}
    return canonicalise(customers, "segment", fixes, ["machines", "cars", "building"])


@query("""
    SELECT 'all' AS step, count(*) AS rows FROM orders
    UNION ALL
    SELECT 'not pending', count(*) FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'one per key', count(*) FROM (
        SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P')
    UNION ALL
    SELECT 'valid priority', count(*) FROM (
        SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P')
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
""")
def row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts along a cleanup: sentinel removed, duplicates removed, categories cleaned."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    fixes = {"1-urgent": "1-URGENT", "2-high": "2-HIGH", "3-medium": "3-MEDIUM"}
    return (
        Traced.start(orders, "all")
        .without("not pending", "o_orderstatus", ["P"])
        .single("one per key", ["o_custkey", "o_orderpriority"])
        .canonical("valid priority", "o_orderpriority", fixes, list(fixes.values()))
        .audit()
    )


@query("""
    SELECT 'all' AS step, count(*) AS rows FROM events
    UNION ALL SELECT 'no error', count(*) FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'and large', count(*) FROM events WHERE event_type <> 'error' AND value > 50
""")
def row_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(
        table(spark, sf_dir, "events"),
        [
            ("all", F.lit(True)),
            ("no error", F.col("event_type") != "error"),
            ("and large", F.col("value") > 50),
        ],
    )


@query("""
    SELECT 'value' AS "column", count(value) AS n, round(avg(value), 6) AS mean,
           round(stddev(value), 6) AS stddev, min(value) AS low, max(value) AS high
    FROM events
    UNION ALL
    SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev(user_id), 6),
           min(user_id), max(user_id)
    FROM events
""")
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = stats(table(spark, sf_dir, "events"), ["value", "user_id"])
    return described.select(
        "column",
        F.col("count").alias("n"),
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.col("min").cast("double").alias("low"),
        F.col("max").cast("double").alias("high"),
    )


@query(
    profile_sql(
        "part",
        {
            "p_partkey": "CAST(p_partkey AS VARCHAR)",
            "p_name": "p_name",
            "p_brand": "p_brand",
            "p_size": "CAST(p_size AS VARCHAR)",
            "p_kind": "CASE WHEN p_size > 5 THEN p_type END",
        },
    )
)
def profile_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_size") > 5, F.col("p_type")).alias("p_kind")
    parts = table(spark, sf_dir, "part")
    return profile(parts.select("p_partkey", "p_name", "p_brand", "p_size", kind))


_SKETCHED = {
    "p_partkey": "CAST(p_partkey AS VARCHAR)",
    "p_name": "p_name",
    "p_brand": "p_brand",
    "p_kind": "CASE WHEN p_size > 5 THEN p_type END",
}


@query(f"""
    SELECT "column", "count", CASE WHEN "unique" <= 1000 THEN top END AS top,
           CASE WHEN "unique" <= 1000 THEN freq END AS freq, true AS close
    FROM ({profile_sql("part", _SKETCHED)})
""")
def profile_sketch_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from sketches, of one scan, held against the exact one.

    Frequent values are told exactly for columns of few values, and only for these; the
    number of distinct values is within the error that comes with it.
    """
    kind = F.when(F.col("p_size") > 5, F.col("p_type")).alias("p_kind")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", kind)
    exact = profile(parts).select("column", F.col("unique").alias("exact"))
    few = F.col("exact") <= 1000
    return profile_sketch(parts).join(exact, "column").select(
        "column", "count", F.when(few, F.col("top")).alias("top"), F.when(few, F.col("freq")).alias("freq"),
        (F.abs(F.col("unique") - F.col("exact")) <= F.col("unique_error") * F.col("exact") + 1).alias("close"),
    )


# Enrichment --------------------------------------------------------------------------

_KNOWN_STATUS = """
    SELECT DISTINCT o_custkey, o_orderstatus AS status
    FROM orders WHERE o_orderpriority <> '1-URGENT'
"""
_ONE_STATUS = f"""
    SELECT o_custkey, max(status) AS status FROM ({_KNOWN_STATUS})
    GROUP BY o_custkey HAVING count(*) = 1
"""


@query(_KNOWN_STATUS)
def derive_dimension_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_dimension(_orders_with_gaps(spark, sf_dir), ["o_custkey", "status"], ["status"])


@query(_ONE_STATUS)
def unique_lookup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_lookup(derive_dimension_orders(spark, sf_dir), ["o_custkey"], "status")


@query(f"""
    SELECT o.o_orderkey, o.o_custkey, o.o_totalprice,
           CASE WHEN o.o_orderpriority <> '1-URGENT' THEN o.o_orderstatus
                ELSE u.status END AS status
    FROM orders o LEFT JOIN ({_ONE_STATUS}) u USING (o_custkey)
""")
def fill_from_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_with_gaps(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_totalprice", "status"
    )
    return fill_from_lookup(orders, unique_lookup_orders(spark, sf_dir), ["o_custkey"], "status")


def _nation_rates(spark: SparkSession, sf_dir: str, minimum: int | None) -> DataFrame:
    customers = count_by(table(spark, sf_dir, "customer"), ["c_nationkey"], name="customers")
    nations = customers.join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("n_nationkey", "n_name", "customers")
    suppliers = count_matrix(
        table(spark, sf_dir, "supplier").select(
            F.col("s_nationkey").alias("n_nationkey"),
            "s_name",
            F.when(F.col("s_acctbal") < 1000, F.lit("low")).otherwise(F.lit("high")).alias("balance"),
        ),
        ["n_nationkey"],
        "balance",
        {"low": "low", "high": "high"},
        "s_name",
    ).where(F.col("total") >= 1)
    return rate_per(nations, suppliers, ["n_nationkey"], "total", "customers", minimum=minimum)


def _nation_rates_sql(condition: str) -> str:
    return f"""
        SELECT n_nationkey, n_name, customers, low, high, total,
               CAST(total * 100000 AS DOUBLE) / customers AS ratio
        FROM (SELECT c_nationkey AS n_nationkey, count(*) AS customers FROM customer GROUP BY 1)
        JOIN nation USING (n_nationkey)
        JOIN (
            SELECT s_nationkey AS n_nationkey, count(*) FILTER (WHERE s_acctbal < 1000) AS low,
                   count(*) FILTER (WHERE s_acctbal >= 1000) AS high, count(s_name) AS total
            FROM supplier GROUP BY 1
        ) USING (n_nationkey)
        {condition}
    """


@query(_nation_rates_sql("") + " ORDER BY ratio DESC, n_nationkey LIMIT 10")
def rate_per_100k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers per 100,000 customers by nation, highest first."""
    return top_k(_nation_rates(spark, sf_dir, None), "ratio", 10, ["n_nationkey"])


@query(_nation_rates_sql("WHERE customers >= 60"))
def rate_per_100k_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for all nations with at least 60 customers."""
    return _nation_rates(spark, sf_dir, 60)


# Reshaping ---------------------------------------------------------------------------


@query("""
    SELECT conv_id, min(text) FILTER (WHERE role = 'user') AS "user",
           min(text) FILTER (WHERE role = 'assistant') AS assistant,
           min(text) FILTER (WHERE role = 'system') AS system
    FROM conversations WHERE role IN ('user', 'assistant', 'system') GROUP BY conv_id
""")
def pivot_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return pivot_first(turns, ["conv_id"], "role", ["user", "assistant", "system"], "text")


@query("""
    SELECT token, count(token) AS documents FROM (
        SELECT unnest(string_split(text, chr(10))) AS token FROM documents
    ) GROUP BY token
""")
def explode_delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("text").alias("token"))
    return count_by(explode_delimited(lines, "token", "\n"), ["token"], "token", "documents")


@query("""
    SELECT token, count(token) AS parts FROM (
        SELECT unnest(string_split(p_name || '|' || p_type || '|', '|')) AS token FROM part
    ) WHERE token <> '' GROUP BY token
""")
def explode_delimited_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by word list with a trailing separator, the empty token dropped."""
    listed = F.concat(F.col("p_name"), F.lit("|"), F.col("p_type"), F.lit("|")).alias("token")
    words = table(spark, sf_dir, "part").select(listed)
    return count_by(explode_delimited(words, "token", "|", True), ["token"], "token", "parts")


@query("""
    SELECT p_brand,
           CAST(sum(CASE WHEN p_size <= 15 THEN p_partkey ELSE 0 END) AS BIGINT) AS upto15,
           CAST(sum(CASE WHEN p_size BETWEEN 16 AND 30 THEN p_partkey ELSE 0 END) AS BIGINT)
               AS from16to30,
           CAST(sum(CASE WHEN p_size >= 31 THEN p_partkey ELSE 0 END) AS BIGINT) AS over30,
           CAST(sum(p_partkey) AS BIGINT) AS total
    FROM part GROUP BY p_brand
""")
def bucket_sums_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = {"upto15": (None, 15), "from16to30": (16, 30), "over30": (31, None)}
    parts = table(spark, sf_dir, "part")
    return bucket_sums(parts, ["p_brand"], "p_size", "p_partkey", buckets, "total")


# Counting and ranking ----------------------------------------------------------------


@query("""
    SELECT p_name, count(CASE WHEN p_size > 10 THEN p_type END) AS total FROM part
    GROUP BY p_name ORDER BY total DESC, p_name LIMIT 30
""")
def count_by_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "part").select(
        "p_name", F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind")
    )
    return top_k(count_by(sized, ["p_name"], "kind"), "total", 30, ["p_name"])


@query("""
    SELECT p_brand, count(p_name) AS total FROM part WHERE p_type = 'PROMO' GROUP BY p_brand
""")
def count_by_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    promo = table(spark, sf_dir, "part").where(F.col("p_type") == "PROMO")
    return count_by(promo, ["p_brand"], "p_name")


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "SELECT user_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{kind}') AS {kind}s" for kind in _EVENT_TYPES
    )
    + ", count(CASE WHEN value >= 20 THEN value END) AS total FROM events GROUP BY user_id"
)
def count_matrix_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.when(F.col("value") >= 20, F.col("value")).alias("large")
    )
    kinds = {f"{kind}s": kind for kind in _EVENT_TYPES}
    return count_matrix(events, ["user_id"], "event_type", kinds, "large")


@query("""
    SELECT user_id, len(kinds) AS size, kinds[1] AS first, array_to_string(kinds, ',') AS kinds
    FROM (SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds FROM events
          WHERE value > 100 GROUP BY user_id)
""")
def value_sets_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "events").where(F.col("value") > 100)
    return value_sets(large, ["user_id"], "event_type", "kinds").select(
        "user_id",
        F.size("kinds").cast("long").alias("size"),
        F.get("kinds", F.lit(0)).alias("first"),
        F.array_join("kinds", ",").alias("kinds"),
    )


@query("""
    SELECT DISTINCT event_type, user_id FROM events WHERE value > 100 AND user_id IS NOT NULL
""")
def value_pairs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "events").where(F.col("value") > 100)
    return value_pairs(large, ["event_type"], "user_id")


@query("""
    SELECT kind, count(DISTINCT o_custkey) AS "size",
           CASE WHEN count(DISTINCT o_custkey) <= 20
                THEN coalesce(array_to_string(list_sort(list(DISTINCT o_custkey)), ','), '') END AS customers
    FROM (SELECT o_custkey, CASE WHEN o_totalprice > 1000 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS kind
          FROM orders)
    GROUP BY kind
""")
def value_sets_up_to_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per day, listed for days of few; orders of small sums have no day, and many customers."""
    day = F.when(F.col("o_totalprice") > 1000, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("kind")
    orders = table(spark, sf_dir, "orders").select(day, "o_custkey")
    found = value_sets_up_to(orders, ["kind"], "o_custkey", 20, "customers")
    return found.select("kind", "size", F.array_join("customers", ",").alias("customers"))


@query("SELECT DISTINCT lang FROM documents")
def distinct_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "documents"), "lang")


@query("""
    SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 12
""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return top_k(customers, "c_acctbal", 12, ["c_custkey"])


@query("""
    SELECT lang, doc_id, source FROM documents
    WHERE source <> 'src0' AND (text LIKE '%tion%' OR text LIKE '%schen%')
    ORDER BY lang, doc_id LIMIT 15
""")
def text_theme_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = text_theme_matches(spark, sf_dir).where(F.col("source") != "src0")
    return top_k(matches, "lang", 15, ["doc_id"], descending=False)


@query("""
    SELECT lang, doc_id, source FROM documents WHERE text LIKE '%tion%' OR text LIKE '%schen%'
""")
def text_theme_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").where(contains_any("text", ["tion", "schen"]))
    return documents.select("lang", "doc_id", "source")


@query("SELECT count(*) AS rows FROM (SELECT * FROM lineitem LIMIT 15)")
def bare_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unordered limit: which rows it returns is open, how many is not."""
    return table(spark, sf_dir, "lineitem").limit(15).agg(F.count(F.lit(1)).alias("rows"))


# Text, numbers, labels ---------------------------------------------------------------


@query("""
    SELECT lang, count(*) AS documents,
           count(*) FILTER (WHERE regexp_matches(text, '[^\\x00-\\x7F]')) AS garbled,
           count(*) AS repaired, count(*) AS untouched
    FROM documents GROUP BY lang
""")
def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents garbled by reading their UTF-8 bytes as Latin-1, then repaired; and the
    clean texts sent through the same repair."""
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    documents = table(spark, sf_dir, "documents").select("lang", "text", garbled.alias("garbled"))
    return documents.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("garbled") != F.col("text")).alias("garbled"),
        F.count_if(repair_text("garbled") == F.col("text")).alias("repaired"),
        F.count_if(repair_text("text") == F.col("text")).alias("untouched"),
    )


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 0
                WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
                ELSE CAST(floor(o_totalprice) AS INTEGER) END AS price
    FROM orders
""")
def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written with thousands dots and parsed back; zero token, blank and malformed."""
    dotted = F.replace(F.format_number(F.floor("o_totalprice"), 0), F.lit(","), F.lit("."))
    written = (
        F.when(F.col("o_orderstatus") == "P", F.lit(".."))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(""))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(dotted, F.lit(" EUR")))
        .otherwise(dotted)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    return orders.select("o_orderkey", to_int("written").alias("price"))


@query("""
    SELECT region, name, age, count(*) AS customers FROM (
        SELECT CASE substr(code, 1, 2) WHEN '05' THEN 'north' WHEN '09' THEN 'south'
                    WHEN '24' THEN 'west' END AS region, c_mktsegment AS name, age
        FROM (
            SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '001' AS code, c_mktsegment,
                   CASE WHEN c_acctbal < 0 THEN NULL
                        ELSE CAST(floor(c_acctbal / 100) AS INTEGER) END AS age
            FROM customer
        ) WHERE code LIKE '05%' OR code LIKE '09%' OR code LIKE '24%'
    ) GROUP BY ALL
""")
def prefix_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ``05001  NAME`` with a worded age: selected by prefix, labelled by code."""
    labels = {"05": "north", "09": "south", "24": "west"}
    code = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("001"))
    years = F.concat(F.floor(F.col("c_acctbal") / 100).cast("string"), F.lit(" años"))
    worded = table(spark, sf_dir, "customer").select(
        F.concat(code, F.lit("  "), F.col("c_mktsegment")).alias("place"),
        F.when(F.col("c_acctbal") < 0, F.lit("Total")).otherwise(years).alias("age"),
    )
    regional = worded.where(has_prefix("place", labels)).select(
        code_to_label(F.substring("place", 1, 2), labels).alias("region"),
        strip_code("place").alias("name"),
        leading_int("age").alias("age"),
    )
    return count_by(regional, ["region", "name", "age"], name="customers")
