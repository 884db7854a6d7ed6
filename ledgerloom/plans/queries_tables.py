"""Queries over aggregates, cleaning, joins, deduplication, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, text as T
from ledgerloom.operators import clean, dedup, extract, index, lookup, profile, relations
from ledgerloom.plans import jobs, landing, queries_text as X, sqltext as S
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import materialize, scratch_path
from ledgerloom.sinks import writers
from ledgerloom.sources import listing, records, tables

# --- counts and dates -------------------------------------------------------------------------


@query("a1_row_counts", "SELECT 'documents' AS name, count(*) AS n FROM documents"
       " UNION ALL SELECT 'orders', count(*) FROM orders")
def _(t):
    named = lambda df, name: profile.row_count(df).select(F.lit(name).alias("name"), "n")
    return named(t.documents, "documents").union(named(t.orders, "orders"))


@query(
    "a2_a3_date_range_span",
    f"""SELECT strftime(min(o_orderdate), {S.STAMP}) AS first, strftime(max(o_orderdate), {S.STAMP}) AS last,
          (epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) // 86400000000 AS span_days FROM orders""",
)
def _(t):
    return profile.date_range(t.orders, F.col("o_orderdate"))


@query(
    "a2_a3_event_span",
    f"""SELECT strftime(min(ts), {S.STAMP}) AS first, strftime(max(ts), {S.STAMP}) AS last,
          (epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 AS span_days FROM events""",
)
def _(t):
    return profile.date_range(t.events, F.col("ts"))


@query("a5_f23_date_histogram", "SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return profile.per_date(t.events, F.col("ts"))


@query("a6_f23_hour_histogram", "SELECT hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return profile.per_hour(t.events, F.col("ts"))


def histogram_sql(value: str, table: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({value} AS DOUBLE) AS v FROM {table} WHERE {value} IS NOT NULL),
      m AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS f,
                   CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS l FROM v),
      g AS (SELECT v, f, l, least(CAST(floor((v - f) / (l - f) * {bins}) AS BIGINT), {bins - 1}) AS g FROM v, m),
      p AS (SELECT CASE WHEN v < g * ((l - f) / {bins}) + f THEN g - 1
                        WHEN g <> {bins - 1} AND v >= (g + 1) * ((l - f) / {bins}) + f THEN g + 1
                        ELSE g END AS bin FROM g)
      SELECT b.bin, round(b.bin * ((l - f) / {bins}) + f, 6) AS lo,
             round(CASE WHEN b.bin = {bins - 1} THEN l ELSE (b.bin + 1) * ((l - f) / {bins}) + f END, 6) AS hi,
             count(p.bin) AS n
      FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN m LEFT JOIN p ON p.bin = b.bin
      GROUP BY 1, 2, 3"""


for _name, _table, _value, _bins in (
    ("a7_document_lengths", "documents", "length(text)", 50),
    ("a7_turn_lengths", "conversations", "length(text)", 20),
    ("a7_constant_lengths", "customer", "length(c_name)", 50),
):
    query(_name, histogram_sql(_value, _table, _bins))(
        lambda t, table=_table, value=_value, bins=_bins: profile.histogram(
            getattr(t, table), F.expr(value), bins
        )
    )


@query(
    "a8_a9_source_share",
    """SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct
       FROM documents GROUP BY 1""",
)
def _(t):
    return profile.with_share(profile.frequencies(t.documents, F.col("source"), "source"))


@query(
    "l4_l5_top_event_types",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3",
)
def _(t):
    return profile.top(profile.frequencies(t.events, F.col("event_type"), "event_type"), 3)


@query(
    "w4_most_common_users",
    """SELECT user_id, n FROM (SELECT user_id, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1)
       ORDER BY n DESC, f LIMIT 10""",
)
def _(t):
    return profile.most_common(t.events, F.col("user_id"), F.col("event_id"), 10, "user_id")


def field_sql(table: str, fields: tuple[str, ...], order: str) -> str:
    part = lambda f: f"""SELECT '{f}' AS field, count(*) AS total, count(*) FILTER ({S.non_blank(f)}) AS non_empty,
        round(count(*) FILTER ({S.non_blank(f)}) / count(*), 6) AS fill_rate,
        round(coalesce(avg(length({f})) FILTER ({S.non_blank(f)}), 0), 6) AS avg_length,
        coalesce((SELECT CASE WHEN length({f}) > 40 THEN substr({f}, 1, 40) || '...' ELSE {f} END
                  FROM {table} WHERE {S.non_blank(f)} ORDER BY {order} LIMIT 1), 'N/A') AS sample FROM {table}"""
    return " UNION ALL ".join(part(f) for f in fields)


@query("a10_a11_document_fields", field_sql("documents", ("text", "lang", "source"), "doc_id"))
def _(t):
    return profile.field_profile(t.documents, ("text", "lang", "source"), F.col("doc_id"))


@query("a10_a11_turn_fields", field_sql("conversations", ("role", "text"), "(conv_id, turn)"))
def _(t):
    return profile.field_profile(t.conversations, ("role", "text"), F.struct("conv_id", "turn"))


# Announcement-like records from documents and their labels; unlabelled ones lack some fields.
RECORDS_SQL = """SELECT d.doc_id, CASE WHEN quality = 0 AND toxic = 1 THEN '' ELSE text END AS title,
    CASE WHEN quality IS NULL THEN NULL ELSE '2024-01-0' || (1 + d.doc_id % 9) END AS published,
    CASE WHEN d.doc_id % 3 = 0 THEN '/doc/' || d.doc_id ELSE 'https://' || source || '.example.org/' || d.doc_id END AS link,
    CASE WHEN toxic = 1 THEN '  ' WHEN toxic = 0 THEN lang END AS category, source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def document_records(t: Tables, documents: DataFrame | None = None, *more: Column) -> DataFrame:
    n = F.col("doc_id")
    joined = (t.documents if documents is None else documents).join(t.labels, "doc_id", "left")
    link = F.when(n % 3 == 0, F.concat(F.lit("/doc/"), n)).otherwise(
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), n)
    )
    return joined.select(
        "doc_id",
        F.when((F.col("quality") == 0) & (F.col("toxic") == 1), "").otherwise(F.col("text")).alias("title"),
        F.when(F.col("quality").isNotNull(), F.concat(F.lit("2024-01-0"), 1 + n % 9)).alias("published"),
        link.alias("link"),
        F.when(F.col("toxic") == 1, "  ").when(F.col("toxic") == 0, F.col("lang")).alias("category"),
        "source",
        *more,
    )


@query(
    "a15_a16_a17_p12_completeness",
    f"""SELECT total, complete, round(complete / total, 6) AS completeness,
          round(categorized / total, 6) AS categorization_rate, complete / total > 0.8 AS suitable
        FROM (SELECT count(*) AS total,
                count(*) FILTER (coalesce(title, '') <> '' AND coalesce(published, '') <> ''
                                 AND coalesce(link, '') <> '') AS complete,
                count(*) FILTER ({S.non_blank('category')}) AS categorized FROM ({RECORDS_SQL}))""",
)
def _(t):
    return profile.completeness(document_records(t))


@query(
    "p13_default_category",
    f"SELECT coalesce(category, 'Unknown') AS category, count(*) AS n FROM ({RECORDS_SQL}) GROUP BY 1",
)
def _(t):
    value = F.coalesce("category", F.lit("Unknown"))
    return profile.frequencies(document_records(t), value, "category")


# Announcements made from customers: titles with tickers, some without a company.
ANNOUNCED_SQL = f"""SELECT c_custkey, title, {S.ticker('title')} AS ticker, {S.company('title')} AS company_name,
    {S.classify('title')} AS rns_type, c_mktsegment AS source FROM ({X.COMPANY_TITLES_SQL}) JOIN customer USING (c_custkey)"""


def announced(t: Tables) -> DataFrame:
    title = F.col("title")
    rows = X.company_titles(t).withColumn("c", T.company_ticker(title))
    return rows.select(
        "c_custkey", "title", "c.ticker", "c.company_name",
        T.classify_announcement(title).alias("rns_type"), F.col("c_mktsegment").alias("source"),
    )


@query(
    "a12_a13_run_metadata",
    f"""SELECT count(*) AS total_records, count(*) FILTER (company_name <> '') AS companies_identified,
          count(*) FILTER (ticker <> '') AS tickers_identified,
          count(DISTINCT nullif(company_name, '')) AS unique_companies,
          count(DISTINCT nullif(ticker, '')) AS unique_tickers FROM ({ANNOUNCED_SQL})""",
)
def _(t):
    return profile.run_metadata(announced(t), "now").drop("scraped_at", "sources", "rns_types")


@query(
    "a14_u4_counters",
    f"""SELECT 'source' AS field, source AS k, count(*) AS n FROM ({ANNOUNCED_SQL}) GROUP BY 2
        UNION ALL SELECT 'rns_type', rns_type, count(*) FROM ({ANNOUNCED_SQL}) GROUP BY 2""",
)
def _(t):
    one = profile.run_metadata(announced(t), "now")
    long = lambda field, column: one.select(F.lit(field).alias("field"), F.explode(column).alias("k", "n"))
    return long("source", "sources").union(long("rns_type", "rns_types"))


@query("u4_distinct_sources", f"SELECT DISTINCT source, rns_type FROM ({ANNOUNCED_SQL})")
def _(t):
    return announced(t).select("source", "rns_type").distinct()


def label_sql(table: str, columns: tuple[str, ...]) -> str:
    part = lambda c: f"""SELECT '{table}' AS tab, '{c}' AS "column", {c} AS value, count(*) AS n FROM {table}
        WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM {table}) BETWEEN 2 AND 99 GROUP BY 3"""
    return " UNION ALL ".join(part(c) for c in columns)


LABELLED = {
    "orders": ("o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_returnflag", "l_linestatus"),
    "part": ("p_name", "p_brand", "p_type"),
    "customer": ("c_name", "c_mktsegment"),
    "documents": ("text", "lang", "source"),
}


@query(
    "a18_p14_p15_label_distributions",
    " UNION ALL ".join(label_sql(table, columns) for table, columns in LABELLED.items()),
)
def _(t):
    return lookup.union_all(
        [
            profile.label_distributions(getattr(t, name)).select(F.lit(name).alias("tab"), "*")
            for name in LABELLED
        ]
    )


@query(
    "f21_rounded_doubles",
    """SELECT o_orderkey, format('{:.1f}', CAST(o_orderkey AS DOUBLE) / 20) AS twentieth,
          format('{:.1f}', -CAST(o_orderkey AS DOUBLE) / 40) AS fortieth,
          format('{:.1f}', o_totalprice) AS price FROM orders""",
)
def _(t):
    key = F.col("o_orderkey").cast("double")
    return t.orders.select(
        "o_orderkey",
        T.one_decimal(key / 20).alias("twentieth"),
        T.one_decimal(-key / 40).alias("fortieth"),
        T.one_decimal(F.col("o_totalprice")).alias("price"),
    )


@query(
    "f21_formatted_counts",
    """SELECT o_orderpriority, format('{:,}', count(*)) AS n_text,
          printf('%.1f%%', count(*) FILTER (o_orderstatus = 'F') / count(*) * 100) AS share
       FROM orders GROUP BY 1""",
)
def _(t):
    done = F.count_if(F.col("o_orderstatus") == "F") / F.count("*")
    return t.orders.groupBy("o_orderpriority").agg(
        T.thousands(F.count("*")).alias("n_text"), T.percent(done).alias("share")
    )


# --- company cleaning -------------------------------------------------------------------------

COMPANIES_SQL = """SELECT o_orderkey, trim(repeat(c_name || ' ', CAST(1 + o_orderkey % 6 AS INT))) AS CompanyName,
    CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%-d/%-m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 2 THEN '31/02/2001' WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%d/%m/%Y') END AS IncorporationDate,
    o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey"""


def companies(t: Tables) -> DataFrame:
    shape = F.col("o_orderkey") % 5
    name = F.expr("trim(repeat(c_name || ' ', cast(1 + o_orderkey % 6 as int)))")
    padded = F.date_format("o_orderdate", "dd/MM/yyyy")
    date = (
        F.when(shape == 0, F.date_format("o_orderdate", "d/M/yyyy"))
        .when(shape == 2, "31/02/2001")
        .when(shape != 3, padded)
    )
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", name.alias("CompanyName"), date.alias("IncorporationDate"), "o_orderdate"
    )


@query(
    "p1_p5_f10_clean_companies",
    f"""SELECT o_orderkey, CompanyName, IncorporationDate, strftime(o_orderdate, '%Y-%m-%d') AS date, 'ch' AS source
        FROM ({COMPANIES_SQL}) WHERE o_orderkey % 5 NOT IN (2, 3)
        AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-30'
        AND length(CompanyName) BETWEEN 1 AND 80""",
)
def _(t):
    raw = companies(t).drop("o_orderdate")
    return clean.clean_companies(raw, min_date="1996-01-01", as_of="1999-06-30")


@query(
    "p2_optional_columns",
    """SELECT c_custkey, c_mktsegment AS CompanyName, CAST(NULL AS VARCHAR) AS date, 'ch' AS source FROM customer
       WHERE length(c_mktsegment) <= 9""",
)
def _(t):
    raw = t.customer.select("c_custkey", F.col("c_mktsegment").alias("CompanyName"))
    return clean.clean_companies(raw, max_name_len=9)


@query(
    "p4_f19_missing_names",
    """SELECT CompanyName, count(*) AS n FROM (SELECT coalesce(CASE WHEN o_orderkey % 4 > 0
         THEN o_orderpriority END, 'nan') AS CompanyName FROM orders)
       WHERE length(CompanyName) BETWEEN 1 AND 8 GROUP BY 1""",
)
def _(t):
    name = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority"))
    raw = t.orders.select(name.alias("CompanyName"))
    return profile.frequencies(
        clean.in_length_range(raw, max_len=8, null_name="nan"), F.col("CompanyName"), "CompanyName"
    )


@query(
    "q4_company_eda_job",
    f"""WITH c AS MATERIALIZED (SELECT *, CASE WHEN o_orderkey % 5 NOT IN (2, 3) THEN strptime(IncorporationDate, '%d/%m/%Y') END AS d,
            length(CompanyName) AS l FROM ({COMPANIES_SQL})),
          h AS ({histogram_sql('l', 'c', 50)})
        SELECT 'rows' AS stat, '' AS key, count(*) AS n FROM c
        UNION ALL SELECT 'date_range', strftime(min(d), '%Y-%m-%d') || ' ' || strftime(max(d), '%Y-%m-%d'),
          date_diff('day', min(d), max(d)) FROM c
        UNION ALL SELECT 'per_date', strftime(d, '%Y-%m-%d'), count(*) FROM c WHERE d IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'name_lengths', CAST(bin AS VARCHAR), n FROM h""",
)
def _(t):
    """All four statistics of the job in long form."""
    eda = jobs.company_eda(companies(t))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    span = F.concat(day("first"), F.lit(" "), day("last")).alias("key")
    parts = [
        ("rows", eda["rows"].select(F.lit("").alias("key"), "n")),
        ("date_range", eda["date_range"].select(span, F.col("span_days").alias("n"))),
        ("per_date", eda["per_date"].select(day("date").alias("key"), "n")),
        ("name_lengths", eda["name_lengths"].select(F.col("bin").cast("string").alias("key"), "n")),
    ]
    return reduce(DataFrame.union, [df.select(F.lit(s).alias("stat"), "key", "n") for s, df in parts])


@query(
    "q4_company_eda",
    f"""SELECT CAST(strptime(IncorporationDate, '%d/%m/%Y') AS DATE) AS date, count(*) AS n
        FROM ({COMPANIES_SQL}) WHERE o_orderkey % 5 NOT IN (2, 3) GROUP BY 1""",
)
def _(t):
    return jobs.company_eda(companies(t))["per_date"]


# --- lookups, unions, splits ------------------------------------------------------------------

SENTIMENTS = ("negative", "neutral", "positive")


@query(
    "j3_f22_label_names",
    """SELECT doc_id, CAST(quality + toxic AS BIGINT) AS label, ['negative', 'neutral', 'positive'][quality + toxic + 1] AS sentiment
       FROM labels""",
)
def _(t):
    label = F.col("quality") + F.col("toxic")
    rows = t.labels.select("doc_id", label.alias("label"))
    return rows.withColumn("sentiment", lookup.label_name(F.col("label"), SENTIMENTS))


@query(
    "j3_label_table",
    """SELECT o_orderkey, r.r_name FROM orders LEFT JOIN region r ON o_orderkey % 7 = r.r_regionkey""",
)
def _(t):
    rows = t.orders.select("o_orderkey", (F.col("o_orderkey") % 7).cast("int").alias("label"))
    names = t.region.select(F.col("r_regionkey").alias("label"), "r_name")
    return lookup.join_label_names(rows, names).select("o_orderkey", "r_name")


@query(
    "k2_s2_q6_phrasebank",
    """SELECT d.doc_id, text AS sentence, CAST(quality AS BIGINT) AS label, ['negative', 'neutral', 'positive'][quality + 1] AS sentiment
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("text").alias("sentence"), F.col("quality").alias("label")
    )
    folder = scratch_path(t.spark, "phrasebank")
    return jobs.label_sentences(rows, SENTIMENTS, folder, "sentences_allagree")


def conversation_configs(t: Tables) -> dict[str, dict[str, DataFrame]]:
    """Three configs with splits train, val and test, by conversation number and role."""
    split_of = F.when(F.col("role") == "user", "train").when(F.col("role") == "assistant", "val")
    turns = t.conversations.withColumn("_split", split_of.otherwise("test"))
    split = lambda rest, name: turns.where(
        (F.col("conv_id") % 3 == rest) & (F.col("_split") == name)
    ).drop("_split")
    return {
        config: {name: split(i, name) for name in ("train", "val", "test")}
        for i, config in enumerate(jobs.POLICY_CONFIGS)
    }


SPLITS_SQL = """SELECT *, ['5768', '78516', '944601'][conv_id % 3 + 1] AS config,
    CASE role WHEN 'user' THEN 'train' WHEN 'assistant' THEN 'val' ELSE 'test' END AS split FROM conversations"""


@query("u3_union_splits", f"SELECT conv_id, turn, config, split FROM ({SPLITS_SQL})")
def _(t):
    union = lookup.union_splits(conversation_configs(t))
    return union.select("conv_id", "turn", "config", "split")


@query("k4_a21_q8_policy_splits", f"SELECT split, count(*) AS n FROM ({SPLITS_SQL}) GROUP BY 1")
def _(t):
    return jobs.policy_splits(conversation_configs(t), scratch_path(t.spark, "splits"))


@query(
    "s9_f24_read_split",
    f"SELECT conv_id, turn, role, text, config, split FROM ({SPLITS_SQL}) WHERE split = 'val'",
)
def _(t):
    path = scratch_path(t.spark, "splits")
    writers.write_splits(lookup.union_splits(conversation_configs(t)), path)
    return tables.read_split(t.spark, path, "validation")


@query(
    "u2_union_by_name",
    """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def _(t):
    s = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    c = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    return lookup.union_all([s, c])


# --- order, shards, line numbers --------------------------------------------------------------


@query("l1_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t):
    return t.orders.orderBy("o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


@query(
    "l2_sample_records",
    f"""SELECT coalesce(title, 'N/A') AS title, coalesce(category, 'N/A') AS category,
          coalesce(published, 'N/A') AS published, source,
          CASE WHEN length(title) > 200 THEN substr(title, 1, 200) || '...' WHEN title <> '' THEN title END AS summary, link
        FROM ({RECORDS_SQL}) ORDER BY doc_id LIMIT 5""",
)
def _(t):
    rows = document_records(t).withColumn("summary", F.col("title"))
    return jobs.sample_records(rows.withColumnRenamed("doc_id", "ord"), 5)


@query(
    "w2_dense_index",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return index.dense_index(rows, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "idx")


@query(
    "k3_w2_shards",
    """SELECT o_orderkey, 'part_' || lpad(CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS VARCHAR), 5, '0') AS part
       FROM orders""",
)
def _(t):
    path = scratch_path(t.spark, "shards")
    writers.write_shards(t.orders, path, 4000, order_by=["o_orderkey"])
    return t.spark.read.parquet(path).select("o_orderkey", "part")


ONE_LINE_SQL = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"


def one_line():
    return F.regexp_replace("text", r"[\r\n]+", " ")


@query(
    "s7_w1_numbered_lines",
    f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, md5({ONE_LINE_SQL}) AS digest FROM documents",
)
def _(t):
    path = landing.write_lines(t.documents, "doc_id", one_line(), "lines")
    lines = index.numbered_lines(t.spark, path, per_file=False)
    return lines.select("line_no", F.md5("value").alias("digest"))


@query(
    "j1_positional_join",
    f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, lang || ' ; ' || source AS tup,
          md5({ONE_LINE_SQL}) AS digest FROM documents""",
)
def _(t):
    spark = t.spark
    sent = landing.write_lines(t.documents, "doc_id", one_line(), "sent")
    tup = landing.write_lines(t.documents, "doc_id", F.concat_ws(" ; ", "lang", "source"), "tup")
    pairs = relations.pair_lines(
        index.numbered_lines(spark, sent, per_file=False), index.numbered_lines(spark, tup, per_file=False)
    )
    return pairs.select("line_no", "tup", F.md5("sent").alias("digest"))


# --- relation triples -------------------------------------------------------------------------

RELATION_SQL = "['africa', 'america', 'asia', 'europe', 'middle east', 'atlantis', ''][p_size % 7 + 1]"
LINES_SQL = f"""SELECT p_partkey AS sent_id, p_name || '  ' || p_type || ' by ' || p_brand AS sent,
    CASE p_partkey % 6 WHEN 0 THEN p_name || ' ; ' || p_brand || ' ; ' || {RELATION_SQL} || ' | bad ; row'
      WHEN 1 THEN '' WHEN 2 THEN p_name || ';' || p_type || ';' || {RELATION_SQL} || ' | ' || p_brand || ' ; ' || p_type || ' ; asia '
      WHEN 3 THEN '   ' WHEN 4 THEN ' | ' || p_brand || ' ; x ; ' || {RELATION_SQL} || ' |'
      ELSE 'a ; b ; c ; d | ' || p_name || ' ;; ' || {RELATION_SQL} END AS tup FROM part"""
TRIPLES_SQL = f"""SELECT sent_id, sent, triple,
    list_transform(string_split(triple, ';'), lambda x: {S.strip('x')}) AS parts
  FROM (SELECT sent_id, sent, {S.strip('u')} AS triple
        FROM (SELECT sent_id, sent, unnest(string_split({S.strip('tup')}, '|')) AS u
              FROM ({LINES_SQL}) WHERE {S.strip('tup')} <> ''))"""


def relation_lines(t: Tables) -> DataFrame:
    names = ("africa", "america", "asia", "europe", "middle east", "atlantis", "")
    rel = F.get(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 7)
    c = lambda *parts: F.concat(*parts)
    name, brand, kind, shape = F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_partkey") % 6
    tup = (
        F.when(shape == 0, c(name, F.lit(" ; "), brand, F.lit(" ; "), rel, F.lit(" | bad ; row")))
        .when(shape == 1, "")
        .when(shape == 2, c(name, F.lit(";"), kind, F.lit(";"), rel, F.lit(" | "), brand, F.lit(" ; "),
                            kind, F.lit(" ; asia ")))
        .when(shape == 3, "   ")
        .when(shape == 4, c(F.lit(" | "), brand, F.lit(" ; x ; "), rel, F.lit(" |")))
        .otherwise(c(F.lit("a ; b ; c ; d | "), name, F.lit(" ;; "), rel))
    )
    sent = c(name, F.lit("  "), kind, F.lit(" by "), brand)
    return t.part.select("p_partkey", sent.alias("sent"), tup.alias("tup"))


def landed_relations(t: Tables, splits: tuple[str, ...] = ("train",)) -> str:
    """A folder with ``<split>.sent``, ``<split>.tup`` and relations.txt; parts go to the splits
    in turn."""
    folder = scratch_path(t.spark, "relations")
    for i, split in enumerate(splits):
        lines = relation_lines(t).where(F.col("p_partkey") % len(splits) == i)
        lines = lines.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey")
        lines.select("sent").write.text(f"{folder}/{split}.sent")
        lines.select("tup").write.text(f"{folder}/{split}.tup")
    names = t.region.select(F.lower(F.concat("r_name", F.lit("  "))).alias("value"))
    names.union(t.region.select(F.lit(" "))).write.text(f"{folder}/relations.txt")
    return folder


@query(
    "q5_j2_f15_p8_p9_relations",
    f"""SELECT array_to_string({S.words('sent')}, ' ') AS tokens, parts[1] AS head_text, parts[2] AS tail_text,
          parts[3] AS relation, sent_id FROM ({TRIPLES_SQL})
        WHERE len(parts) = 3 AND parts[3] IN (SELECT lower(r_name) FROM region)""",
)
def _(t):
    examples = relations.load_relations(t.spark, "train", landed_relations(t))
    return examples.withColumn("tokens", F.array_join("tokens", " "))


def relation_pairs(t: Tables) -> DataFrame:
    return relation_lines(t).withColumnRenamed("p_partkey", "line_no")


def valid_relations(t: Tables) -> DataFrame:
    return t.region.select(F.lower("r_name").alias("relation"))


@query(
    "a23_examples_per_relation",
    f"""SELECT parts[3] AS relation, count(*) AS n FROM ({TRIPLES_SQL})
        WHERE len(parts) = 3 AND parts[3] IN (SELECT lower(r_name) FROM region) GROUP BY 1""",
)
def _(t):
    examples = relations.relation_examples(relation_pairs(t), valid_relations(t))
    return profile.frequencies(examples, F.col("relation"), "relation")


@query(
    "a23_examples_per_split",
    f"""SELECT ['train', 'dev', 'test'][sent_id % 3 + 1] AS split, count(*) AS n FROM ({TRIPLES_SQL})
        WHERE len(parts) = 3 AND parts[3] IN (SELECT lower(r_name) FROM region) GROUP BY 1""",
)
def _(t):
    splits = ("train", "dev", "test")
    return relations.examples_per_split(
        relations.load_splits(t.spark, landed_relations(t, splits), splits)
    )


@query(
    "p8_rejected_triples",
    f"""SELECT sent_id, triple, CASE WHEN len(parts) <> 3 THEN 'malformed' ELSE 'unknown relation' END AS reason
        FROM ({TRIPLES_SQL}) WHERE len(parts) <> 3 OR parts[3] NOT IN (SELECT lower(r_name) FROM region)""",
)
def _(t):
    return relations.rejected_triples(relation_pairs(t), valid_relations(t))


@query(
    "s8_line_set",
    f"SELECT DISTINCT {S.strip('p_name')} AS value FROM part",
)
def _(t):
    padded = F.concat(F.lit(" "), "p_name", F.lit("\t"))
    path = landing.write_lines(t.part, "p_partkey", padded, "names")
    return records.line_set(t.spark, path)


# --- near-duplicates --------------------------------------------------------------------------


PAIRS_SQL = """e AS (SELECT b.ord, list(a.ord) AS nb FROM s a JOIN s b ON a.ord < b.ord AND len(a.w) > 0 AND len(b.w) > 0
            WHERE CAST({shared} AS DOUBLE) / (len(a.w) + len(b.w) - {shared}) > 0.7 GROUP BY 1)"""


def dedup_sql(base: str, select: str, by_word: bool = False) -> str:
    """Greedy keep-first over ``base`` (``ord, title``, ``ord`` a number). ``by_word`` finds the
    similar pairs by an equi-join on words, for texts too long to compare all pairs of."""
    shared = "len(list_intersect(a.w, b.w))"
    if by_word:
        return dedup_sql(base, select).replace(
            PAIRS_SQL.format(shared=shared),
            """e AS (SELECT ord, list(a_ord) AS nb FROM (
                 SELECT b.ord, a.ord AS a_ord, count(*) AS c, any_value(a.n) AS an, any_value(b.n) AS bn
                 FROM (SELECT ord, len(w) AS n, unnest(w) AS x FROM s) a
                 JOIN (SELECT ord, len(w) AS n, unnest(w) AS x FROM s) b
                   ON a.x = b.x AND a.ord < b.ord AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n)
                 GROUP BY 1, 2) WHERE CAST(c AS DOUBLE) / (an + bn - c) > 0.7 GROUP BY 1)""",
        )
    return f"""WITH RECURSIVE base AS MATERIALIZED ({base}), s AS MATERIALIZED (SELECT ord, {S.word_set('title')} AS w FROM base),
      {PAIRS_SQL.format(shared=shared)},
      n AS MATERIALIZED (SELECT s.ord, row_number() OVER (ORDER BY s.ord) AS i, coalesce(nb, []) AS nb
            FROM s LEFT JOIN e ON s.ord = e.ord),
      r AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept
            UNION ALL SELECT n.i, CASE WHEN len(list_intersect(r.kept, n.nb)) = 0
                                   THEN list_append(r.kept, n.ord) ELSE r.kept END
            FROM r JOIN n ON n.i = r.i + 1),
      k AS (SELECT unnest(kept) AS ord FROM r WHERE i = (SELECT count(*) FROM s))
      {select}"""


PAGE_TITLES_SQL = f"SELECT page_id AS ord, title FROM ({X.TITLES_SQL})"


def page_title_status(t: Tables) -> DataFrame:
    rows = X.titles(t).withColumnRenamed("page_id", "ord")
    return dedup.duplicate_status(rows, 0.7)


@query(
    "u6_j5_dedup_titles",
    dedup_sql(PAGE_TITLES_SQL, "SELECT ord, title FROM base WHERE ord IN (SELECT ord FROM k)"),
)
def _(t):
    return page_title_status(t).where("kept").drop("kept")


@query(
    "a22_dedup_counts",
    dedup_sql(
        PAGE_TITLES_SQL,
        """SELECT count(*) AS before, (SELECT count(*) FROM k) AS after,
                  count(*) - (SELECT count(*) FROM k) AS removed FROM base""",
    ),
)
def _(t):
    return dedup.dedup_counts(page_title_status(t))


@query(
    "u6_dedup_documents",
    dedup_sql(
        "SELECT doc_id AS ord, text AS title FROM documents",
        "SELECT ord AS doc_id FROM k",
        by_word=True,
    ),
)
def _(t):
    rows = t.documents.select("doc_id", "text")
    return dedup.remove_near_duplicates(rows, 0.7, "text", "doc_id").select("doc_id")


COLLECTED_SQL = f"""SELECT row_number() OVER (ORDER BY rank, page_id, pos) AS ord, source, title, link FROM (
    SELECT 0 AS rank, page_id, pos, source, title, link FROM ({X.record_sql(X.INVESTEGATE, X.NEWS_SQL, X.PREFIX_SQL, 50)})
    UNION ALL SELECT 1, page_id, pos, source, title, link FROM ({X.record_sql(X.LSE, X.LSE_SQL, X.join_sql(X.LSE.site), 50)})
    UNION ALL SELECT 3, page_id, pos, source, title, link FROM ({X.record_sql(X.SHARECAST, X.SHARECAST_SQL, X.join_sql(X.SHARECAST.site), 50)}))"""


@query(
    "q1_w3_unique_announcements",
    dedup_sql(COLLECTED_SQL, "SELECT source, title, link FROM base WHERE ord IN (SELECT ord FROM k)"),
)
def _(t):
    found = materialize(extract.collect_sources(X.all_branches(t)), "found")
    return dedup.remove_near_duplicates(found, 0.7).select("source", "title", "link")


def collection_sql(collected: str) -> str:
    return dedup_sql(
        collected.replace("SELECT row_number() OVER (ORDER BY rank, page_id, pos) AS ord, source, title, link FROM (", "SELECT row_number() OVER (ORDER BY rank, page_id, pos) AS ord, source, title, link, rns_type, company_name FROM (")
        .replace("page_id, pos, source, title, link FROM", "page_id, pos, source, title, link, rns_type, company_name FROM"),
        """, u AS (SELECT * FROM base WHERE ord IN (SELECT ord FROM k))
           SELECT 'before' AS stat, '' AS key, count(*) AS n FROM base
           UNION ALL SELECT 'after', '', count(*) FROM u
           UNION ALL SELECT 'removed', '', (SELECT count(*) FROM base) - (SELECT count(*) FROM u)
           UNION ALL SELECT 'source', source, count(*) FROM u GROUP BY 2
           UNION ALL SELECT 'type', rns_type, count(*) FROM u GROUP BY 2
           UNION ALL SELECT * FROM (SELECT 'company', company_name, count(*) AS n FROM u WHERE company_name <> ''
                                    GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
           UNION ALL SELECT 'stored', '', count(*) FROM u""",
    )


WHOLE_COLLECTED_SQL = f"""SELECT row_number() OVER (ORDER BY rank, page_id, pos) AS ord, source, title, link FROM (
    SELECT 0 AS rank, page_id, pos, source, title, link FROM ({X.record_sql(X.INVESTEGATE, X.NEWS_SQL, X.PREFIX_SQL, None)})
    UNION ALL SELECT 1, page_id, pos, source, title, link FROM ({X.record_sql(X.LSE, X.LSE_SQL, X.join_sql(X.LSE.site), None)})
    UNION ALL SELECT 3, page_id, pos, source, title, link FROM ({X.record_sql(X.SHARECAST, X.SHARECAST_SQL, X.join_sql(X.SHARECAST.site), None)}))"""


@query(
    "q1_w3_unique_announcements_whole",
    dedup_sql(WHOLE_COLLECTED_SQL, "SELECT source, title, link FROM base WHERE ord IN (SELECT ord FROM k)"),
)
def _(t):
    found = materialize(extract.collect_sources(X.all_branches(t, None)), "found")
    return dedup.remove_near_duplicates(found, 0.7).select("source", "title", "link")


@query("q1_collection_job", collection_sql(COLLECTED_SQL))
def _(t):
    return collection_job(t, 50)


@query("q1_collection_job_whole", collection_sql(WHOLE_COLLECTED_SQL))
def _(t):
    return collection_job(t, None)


def collection_job(t: Tables, limit: int | None) -> DataFrame:
    """The collection job from pages to files: what its summary counts, and what it stored."""
    pages = {"investegate": X.news_pages(t), "lse": X.lse_pages(t), "sharecast": X.sharecast_pages(t)}
    run = jobs.collect_announcements(
        pages, scratch_path(t.spark, "runs"), limit=limit, scraped_at=F.lit(X.STAMP)
    )
    counts = run.counts.unpivot([], ["before", "after", "removed"], "stat", "n")
    parts = [
        counts.select("stat", F.lit("").alias("key"), "n"),
        run.by_source.select(F.lit("source").alias("stat"), F.col("source").alias("key"), "n"),
        run.by_type.select(F.lit("type"), "rns_type", "n"),
        run.top_companies.select(F.lit("company"), "company_name", "n"),
        records.read_announcements(t.spark, f"{run.path}/records").agg(
            F.lit("stored"), F.lit(""), F.count("*")
        ),
    ]
    return reduce(DataFrame.union, parts)


# --- sources and sinks ------------------------------------------------------------------------


@query(
    "s1_csv_inferred",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
          CASE WHEN o_orderkey % 9 > 0 THEN o_orderstatus || ',"' || chr(10) || 'x' END AS note FROM orders""",
)
def _(t):
    note = F.when(F.col("o_orderkey") % 9 == 0, "NA").otherwise(F.concat("o_orderstatus", F.lit(',"\nx')))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", note.alias("note"))
    path = writers.write_csv(rows, scratch_path(t.spark, "csv"))
    return tables.read_csv(t.spark, path)


@query(
    "s3_u2_csv_tree",
    """SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region
       UNION ALL BY NAME SELECT n_name AS r_name, CAST(n_nationkey AS BIGINT) AS n_nationkey FROM nation
       UNION ALL BY NAME SELECT c_custkey, c_acctbal, c_mktsegment AS r_name FROM customer""",
)
def _(t):
    base = scratch_path(t.spark, "tree")
    writers.write_csv(t.region, f"{base}/a/region")
    writers.write_csv(t.nation.select(F.col("n_name").alias("r_name"), "n_nationkey"), f"{base}/b")
    rows = t.customer.select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("r_name"))
    writers.write_csv(rows, f"{base}/c/d")
    return tables.read_csv_tree(t.spark, base)


def landed_zips(t: Tables) -> str:
    folder = scratch_path(t.spark, "zips")
    rows = t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit('\n"x"')).alias("CompanyName"),
        F.when(F.col("c_custkey") % 5 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.expr("concat_ws('/', 1 + c_custkey % 28, 1 + c_custkey % 12, 1990 + c_custkey % 40)").alias(
            "IncorporationDate"
        ),
    )
    landing.land(landing.zip_parts(rows, "c_custkey", 400), folder)
    return folder


ZIP_SQL = """SELECT c_custkey, c_name || chr(10) || '"x"' AS CompanyName,
    CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS segment,
    (1 + c_custkey % 28) || '/' || (1 + c_custkey % 12) || '/' || (1990 + c_custkey % 40) AS IncorporationDate
  FROM customer"""


@query("s4_zip_csv_scan", f"SELECT * REPLACE (CAST(c_custkey AS VARCHAR) AS c_custkey) FROM ({ZIP_SQL})")
def _(t):
    return tables.read_zip_csv(t.spark, landed_zips(t))


@query(
    "q3_l6_company_shards",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, date,
          'part_' || lpad(CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 300 AS VARCHAR), 5, '0') AS part
        FROM (SELECT c_custkey, strftime(make_date(1990 + c_custkey % 40, 1 + c_custkey % 12, 1 + c_custkey % 28), '%Y-%m-%d') AS date
              FROM customer WHERE make_date(1990 + c_custkey % 40, 1 + c_custkey % 12, 1 + c_custkey % 28)
                BETWEEN DATE '1995-01-01' AND DATE '2024-06-30')""",
)
def _(t):
    out = scratch_path(t.spark, "companies")
    jobs.clean_company_parts(
        t.spark, landed_zips(t), out, 300, min_date="1995-01-01", as_of="2024-06-30"
    )
    return t.spark.read.parquet(out).select("c_custkey", "date", "part")


def landed_jsonl(t: Tables) -> str:
    """JSONL files of documents: records, broken lines, blank lines, trailing text, headers."""
    shape = F.col("doc_id") % 7
    record = F.to_json(
        F.struct(
            F.col("text").alias("title"), "source", F.col("lang").alias("category"),
            F.col("doc_id").alias("guid"), (F.col("doc_id") % 3).alias("source_priority"),
        )
    )
    line = (
        F.when(shape < 4, record)
        .when(shape == 4, '{"title": "cut')
        .when(shape == 5, "   ")
        .otherwise(F.concat(record, F.lit(" tail")))
    )
    header = F.when(F.col("doc_id") % 100 == 0, F.lit('{"_metadata": {"total_records": 9}}\n')).otherwise("")
    folder = scratch_path(t.spark, "jsonl")
    files = landing.line_files(t.documents, "doc_id", F.concat(header, line), 100, "rns_%05d.jsonl")
    landing.land(files, folder)
    return folder


@query(
    "s5_f20_tolerant_jsonl",
    """SELECT text AS title, source, lang AS category, CAST(doc_id AS VARCHAR) AS guid,
          doc_id % 3 AS source_priority FROM documents WHERE doc_id % 7 < 4""",
)
def _(t):
    found = records.read_announcements(t.spark, landed_jsonl(t))
    return found.select("title", "source", "category", "guid", "source_priority")


@query(
    "s5b_line_report",
    """SELECT 'rns_' || lpad(CAST(doc_id // 100 AS VARCHAR), 5, '0') || '.jsonl' AS file,
          count(*) FILTER (doc_id % 7 < 4) + 1 AS records, count(*) FILTER (doc_id % 7 IN (4, 6)) AS bad_lines
       FROM documents GROUP BY 1""",
)
def _(t):
    return records.jsonl_line_report(t.spark, landed_jsonl(t))


@query(
    "s5b_rejected_line_numbers",
    """SELECT 'rns_' || lpad(CAST(doc_id // 100 AS VARCHAR), 5, '0') || '.jsonl' AS file,
          doc_id % 100 + 2 AS line_no FROM documents WHERE doc_id % 7 IN (4, 6) AND doc_id % 100 > 0
       UNION ALL SELECT 'rns_' || lpad(CAST(doc_id // 100 AS VARCHAR), 5, '0') || '.jsonl', 2
       FROM documents WHERE doc_id % 7 IN (4, 6) AND doc_id % 100 = 0""",
)
def _(t):
    return records.rejected_lines(t.spark, landed_jsonl(t)).select("file", "line_no")


@query("s6_jsonl_line_count", "SELECT count(*) + count(*) FILTER (doc_id % 100 = 0) AS num_rows FROM documents")
def _(t):
    return records.jsonl_line_count(t.spark, landed_jsonl(t))


def landed_feed(t: Tables) -> str:
    item = F.concat(
        F.lit("<item><title>"), F.col("title"), F.lit(" &amp;amp; more</title><link>https://example.org/"),
        F.col("c_custkey"), F.lit("</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate><description>&lt;p&gt;"),
        F.col("c_mktsegment"), F.lit("&lt;/p&gt;  dividend</description><category>one</category><category>two</category>"
                                     '<guid isPermaLink="false">g'),
        F.col("c_custkey"), F.lit("</guid></item>"),
    )
    folder = scratch_path(t.spark, "feed")
    files = landing.line_files(
        X.company_titles(t), "c_custkey", item, 150, "feed_%03d.xml",
        '<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel><title>feed</title>\n',
        "</channel></rss>\n",
    )
    landing.land(files, folder)
    return folder


FEED_SQL = f"""SELECT 'feed_' || lpad(CAST(c_custkey // 150 AS VARCHAR), 3, '0') || '.xml' AS file, c_custkey % 150 AS pos,
    title || ' &amp; more' AS title, 'https://example.org/' || c_custkey AS link,
    'Tue, 02 Jan 2024 03:04:05 GMT' AS published, '<p>' || c_mktsegment || '</p>  dividend' AS summary,
    'one' AS category, 'g' || c_custkey AS guid FROM ({X.COMPANY_TITLES_SQL}) JOIN customer USING (c_custkey)"""


@query("s13_xml_feed", FEED_SQL)
def _(t):
    return records.read_feed(t.spark, landed_feed(t), limit=None)


def landed_odd_feed(t: Tables) -> str:
    """A feed in which every seventh entry has a bare ampersand."""
    mark = F.when(F.col("n_nationkey") % 7 == 0, " & ").otherwise(" &amp; ")
    item = F.concat(F.lit("<item><title>"), "n_name", mark, F.lit("x</title><link>l"), "n_nationkey", F.lit("</link></item>"))
    folder = scratch_path(t.spark, "odd-feed")
    files = landing.line_files(t.nation, "n_nationkey", item, 10, "odd_%03d.xml", "<rss><channel>\n", "</channel></rss>\n")
    landing.land(files, folder)
    return folder


ODD_FEED_SQL = """SELECT 'odd_' || lpad(CAST(n_nationkey // 10 AS VARCHAR), 3, '0') || '.xml' AS file, n_nationkey % 7 = 0 AS odd,
    n_name || ' & x' AS title, 'l' || n_nationkey AS link FROM nation"""


@query("s13_entries_beside_rejects", f"SELECT file, title, link FROM ({ODD_FEED_SQL}) WHERE NOT odd")
def _(t):
    return records.read_feed(t.spark, landed_odd_feed(t)).select("file", "title", "link")


@query(
    "s13_rejected_entries",
    f"SELECT file, '<item><title>' || title || '</title><link>' || link || '</link></item>' AS value FROM ({ODD_FEED_SQL}) WHERE odd",
)
def _(t):
    return records.rejected_entries(t.spark, landed_odd_feed(t))


@query(
    "s13_feed_announcements",
    f"""SELECT file, pos, {S.clean('title')} AS title, {S.clean('summary')} AS summary, link, category, guid,
          {S.ticker(S.clean('title'))} AS ticker, {S.company(S.clean('title'))} AS company_name,
          {S.classify(S.clean('title') + " || ' ' || " + S.clean('summary'))} AS rns_type
        FROM ({FEED_SQL}) WHERE pos < 20""",
)
def _(t):
    entries = records.read_feed(t.spark, landed_feed(t), limit=20)
    found = extract.announcements_from_feed(entries, F.lit(X.STAMP))
    return found.select(
        "file", "pos", "title", "summary", "link", "category", "guid", "ticker", "company_name", "rns_type"
    )


@query(
    "s13_feed_announcements_whole",
    f"""SELECT file, pos, {S.clean('title')} AS title, {S.clean('summary')} AS summary, link, category, guid,
          {S.ticker(S.clean('title'))} AS ticker, {S.company(S.clean('title'))} AS company_name,
          {S.classify(S.clean('title') + " || ' ' || " + S.clean('summary'))} AS rns_type
        FROM ({FEED_SQL})""",
)
def _(t):
    entries = records.read_feed(t.spark, landed_feed(t), limit=None)
    found = extract.announcements_from_feed(entries, F.lit(X.STAMP))
    return found.select(
        "file", "pos", "title", "summary", "link", "category", "guid", "ticker", "company_name", "rns_type"
    )


@query(
    "k1_announcement_sink",
    f"SELECT title, ticker, company_name, rns_type, source FROM ({ANNOUNCED_SQL})",
)
def _(t):
    rows = announced(t).drop("c_custkey")
    out = writers.write_announcements(rows, scratch_path(t.spark, "runs"))
    back = records.read_announcements(t.spark, f"{out}/records")
    return back.select("title", "ticker", "company_name", "rns_type", "source")


ORDERS_HEAD, PART_HEAD = "o_orderkey,o_orderstatus,o_orderpriority", "p_partkey,p_type,p_brand"


def landed_datasets(t: Tables) -> str:
    """Files of known bytes, some hidden or nested."""
    base = scratch_path(t.spark, "raw")
    comma = lambda head: F.concat_ws(",", *[F.col(c).cast("string") for c in head.split(",")])
    for df, key, line, size, name, head in (
        (t.orders, "o_orderkey", comma(ORDERS_HEAD), 5000, "ch_orders/o_%05d.csv", ORDERS_HEAD),
        (t.part, "p_partkey", comma(PART_HEAD), 1000, "boe_cls_part/deep/p_%05d.csv", PART_HEAD),
        (t.documents, "doc_id", F.to_json(F.struct("doc_id", "lang")), 200, "rns_documents/d_%05d.jsonl", ""),
        (t.nation, "n_nationkey", F.col("n_name"), 10, "px_nation/raw/x/.n_%05d.txt", ""),
    ):
        head = f"{head}\n" if head else ""
        landing.land(landing.line_files(df, key, line, size, name, head), base)
    return base


SIZES_SQL = f"""SELECT 'ch_orders' AS dataset, 'csv' AS format, CAST(NULL AS BIGINT) AS files,
    CAST(sum(strlen(concat_ws(',', {ORDERS_HEAD})) + 1) + count(DISTINCT o_orderkey // 5000) * {len(ORDERS_HEAD) + 1} AS BIGINT) AS size_bytes FROM orders
  UNION ALL SELECT 'boe_cls_part', 'csv', NULL,
    sum(strlen(concat_ws(',', {PART_HEAD})) + 1) + count(DISTINCT p_partkey // 1000) * {len(PART_HEAD) + 1} FROM part
  UNION ALL SELECT 'rns_documents', 'jsonl', NULL,
    sum(strlen('{{"doc_id":' || doc_id || ',"lang":"' || lang || '"}}') + 1) FROM documents
  UNION ALL SELECT 'px_nation', 'other', count(DISTINCT n_nationkey // 10) + 2, sum(strlen(n_name) + 1) FROM nation"""


def use_of(name: str) -> str:
    return next(v for k, v in reversed(list(lookup.IDEAL_USES.items())) if k in name)


@query(
    "q7_k6_overview",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, {rows} AS rows, '{use_of(name)}' AS ideal_use, "
        f"(SELECT format('{{:.1f}}', size_bytes / 1e6) FROM ({SIZES_SQL}) WHERE dataset = '{name}') AS size_mb{source}"
        for name, rows, source in (
            ("ch_orders", "format('{:,}', count(*))", " FROM orders"),
            ("boe_cls_part", "format('{:,}', count(*))", " FROM part"),
            ("rns_documents", "format('{:,}', count(*))", " FROM documents"),
            ("px_nation", "'-'", ""),
        )
    ),
)
def _(t):
    cards = jobs.profile_datasets(t.spark, landed_datasets(t))
    return writers.overview(cards)


@query(
    "k5_a18_cards",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{column}' AS "column", {column} AS value, count(*) AS n FROM {table} GROUP BY 3"""
        for name, table, column in (
            ("ch_orders", "orders", "o_orderstatus"),
            ("ch_orders", "orders", "o_orderpriority"),
            ("boe_cls_part", "part", "p_type"),
            ("boe_cls_part", "part", "p_brand"),
        )
    ),
)
def _(t):
    cards = jobs.profile_datasets(t.spark, landed_datasets(t))
    out = writers.write_cards(cards, scratch_path(t.spark, "cards"))
    schema = (
        "name string, path string, size_bytes long, num_rows long, columns array<string>, "
        "label_distributions map<string, map<string, long>>, format string, files long, ideal_use string"
    )
    back = t.spark.read.schema(schema).json(out)
    columns = back.select("name", F.explode("label_distributions").alias("column", "counts"))
    return columns.select("name", "column", F.explode("counts").alias("value", "n"))


@query("s15_dataset_formats", f"SELECT dataset, format, files FROM ({SIZES_SQL})")
def _(t):
    """Formats of folders written from the tables, with files and folders of the nation's."""
    sizes = listing.dataset_sizes(listing.dataset_files(t.spark, landed_datasets(t)))
    return sizes.select("dataset", "format", "files")


@query("s14_s15_a19_dataset_sizes", SIZES_SQL)
def _(t):
    """Sizes in bytes of landed folders; a test compares with the disk as well."""
    return listing.dataset_sizes(listing.dataset_files(t.spark, landed_datasets(t)))


@query(
    "q2_announcement_eda",
    f"""SELECT 'complete' AS stat, CAST(count(*) FILTER (title <> '' AND published <> '' AND link <> '') AS VARCHAR) AS value
          FROM ({RECORDS_SQL})
        UNION ALL SELECT 'first', min(published) || ' 00:00:00' FROM ({RECORDS_SQL})
        UNION ALL SELECT 'domain ' || {S.domain('link')}, CAST(count(*) AS VARCHAR) FROM ({RECORDS_SQL})
          WHERE {S.domain('link')} IS NOT NULL GROUP BY {S.domain('link')}""",
)
def _(t):
    rows = document_records(t).select(
        F.col("doc_id").alias("ord"), "title", "published", "link", "category", "source",
        F.lit("").alias("summary"), F.lit("x").alias("author"),
    )
    eda = jobs.announcement_eda(rows)
    counts = profile.frequencies(rows, T.link_domain(F.col("link")), "domain")
    return (
        eda["completeness"].select(F.lit("complete").alias("stat"), F.col("complete").cast("string").alias("value"))
        .union(eda["date_range"].select(F.lit("first"), F.col("first").cast("string")))
        .union(
            counts.where("domain IS NOT NULL").select(
                F.concat(F.lit("domain "), "domain"), F.col("n").cast("string")
            )
        )
    )


EDA_ROWS_SQL = f"SELECT *, source AS summary, 'x' AS author, CAST(published AS TIMESTAMP) AS ts FROM ({RECORDS_SQL})"


def eda_common_sql(stat: str, value: str) -> str:
    return f"""SELECT '{stat}', v, CAST(n AS DOUBLE) FROM (SELECT {value} AS v, count(*) AS n, min(doc_id) AS o
      FROM r WHERE {value} IS NOT NULL GROUP BY 1 ORDER BY n DESC, o LIMIT 10)"""


EDA_COMPLETE_SQL = "count(*) FILTER (title <> '' AND published <> '' AND link <> '')"
EDA_SQL = f"""WITH r AS MATERIALIZED ({EDA_ROWS_SQL}),
    p AS MATERIALIZED ({field_sql('r', profile.PROFILE_FIELDS, 'doc_id')}),
    t AS MATERIALIZED (SELECT length(title) AS l FROM r WHERE {S.non_blank('title')}),
    u AS MATERIALIZED (SELECT length(summary) AS l FROM r WHERE {S.non_blank('summary')}),
    th AS ({histogram_sql('l', 't', 20)}), uh AS ({histogram_sql('l', 'u', 20)}),
    f AS (SELECT * FROM r ORDER BY doc_id LIMIT 5)
  SELECT 'rows' AS stat, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM r
  UNION ALL SELECT 'parse_rate', 'parsed', count(ts) FROM r
  UNION ALL SELECT 'parse_rate', 'total', count(*) FROM r
  UNION ALL SELECT 'parse_rate', 'rate', count(ts) / count(*) FROM r
  UNION ALL SELECT 'date_range', strftime(min(ts), '%Y-%m-%d') || ' ' || strftime(max(ts), '%Y-%m-%d'),
    date_diff('day', min(ts), max(ts)) FROM r
  UNION ALL SELECT 'formats', '%Y-%m-%d', count(ts) FROM r HAVING count(ts) > 0
  UNION ALL SELECT 'per_date', strftime(ts, '%Y-%m-%d'), count(*) FROM r WHERE ts IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'per_hour', CAST(hour(ts) AS VARCHAR), count(*) FROM r WHERE ts IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'fields', field || ' total ' || sample, total FROM p
  UNION ALL SELECT 'fields', field || ' non_empty', non_empty FROM p
  UNION ALL SELECT 'fields', field || ' fill_rate', fill_rate FROM p
  UNION ALL SELECT 'fields', field || ' avg_length', avg_length FROM p
  UNION ALL SELECT 'title_lengths', bin || ' n', n FROM th
  UNION ALL SELECT 'title_lengths', bin || ' lo', lo FROM th
  UNION ALL SELECT 'title_lengths', bin || ' hi', hi FROM th
  UNION ALL SELECT 'summary_lengths', bin || ' n', n FROM uh
  UNION ALL SELECT 'summary_lengths', bin || ' lo', lo FROM uh
  UNION ALL SELECT 'summary_lengths', bin || ' hi', hi FROM uh
  UNION ALL {eda_common_sql('categories', "coalesce(category, 'Unknown')")}
  UNION ALL SELECT 'samples', concat_ws('|', coalesce(title, 'N/A'), coalesce(category, 'N/A'), coalesce(published, 'N/A'),
    coalesce(source, 'N/A'), CASE WHEN length(summary) > 200 THEN substr(summary, 1, 200) || '...' WHEN summary <> '' THEN summary END,
    CASE WHEN link <> '' THEN link END), 1 FROM f
  UNION ALL SELECT 'sources', coalesce(source, 'unknown') || ' n', count(*) FROM r GROUP BY 2
  UNION ALL SELECT 'sources', coalesce(source, 'unknown') || ' pct', 100 * count(*) / (SELECT count(*) FROM r) FROM r GROUP BY 2
  UNION ALL {eda_common_sql('authors', "author")}
  UNION ALL {eda_common_sql('domains', S.domain('link'))}
  UNION ALL SELECT 'completeness', 'total', count(*) FROM r
  UNION ALL SELECT 'completeness', 'complete', {EDA_COMPLETE_SQL} FROM r
  UNION ALL SELECT 'completeness', 'completeness', {EDA_COMPLETE_SQL} / count(*) FROM r
  UNION ALL SELECT 'completeness', 'categorization_rate', count(*) FILTER ({S.non_blank('category')}) / count(*) FROM r
  UNION ALL SELECT 'completeness', 'suitable', CAST({EDA_COMPLETE_SQL} / count(*) > 0.8 AS INTEGER) FROM r"""


@query("q2_announcement_eda_job", EDA_SQL)
def _(t):
    """All fifteen statistics of the job in long form."""
    others = [F.col("source").alias("summary"), F.lit("x").alias("author")]
    fields = [F.col("doc_id").alias("ord"), "title", "published", "link", "category", "source", *others]
    rows = document_records(t).select(*fields)
    # Texts are measured before labels join, so the join does not carry them.
    texts = t.documents.withColumn("title", F.col("text"))
    measured = texts.select("doc_id", "lang", "source", F.substring("text", 1, 1).alias("text"),
                            *profile.field_measures(["title"]))
    hidden = F.coalesce((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(False))
    shown = [F.when(~hidden, F.col(c)).alias(c) for c in ("_len_title", "_cut_title")]
    measured = document_records(t, measured, *shown).select(*fields, "_len_title", "_cut_title")
    eda = jobs.announcement_eda(rows, measures=jobs.announcement_measures(measured, measured=["title"]))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    shown = [F.col(c) for c in ("title", "category", "published", "source", "summary", "link")]
    span = F.concat(day("first"), F.lit(" "), day("last"))

    def long(stat: str, key: Column, value: Column) -> DataFrame:
        return eda[stat].select(F.lit(stat).alias("stat"), key.alias("key"), value.cast("double").alias("value"))

    def wide(stat: str, of: str | None, *names: str) -> list[DataFrame]:
        key = lambda c: F.lit(c) if of is None else F.concat(F.col(of).cast("string"), F.lit(f" {c}"))
        return [long(stat, key(c), F.col(c)) for c in names]

    n = F.col("n")
    parts = [
        long("rows", F.lit(""), n),
        *wide("parse_rate", None, "parsed", "total", "rate"),
        long("date_range", span, F.col("span_days")),
        long("formats", F.col("fmt"), n),
        long("per_date", day("date"), n),
        long("per_hour", F.col("hour").cast("string"), n),
        long("fields", F.concat("field", F.lit(" total "), "sample"), F.col("total")),
        *wide("fields", "field", "non_empty", "fill_rate", "avg_length"),
        *wide("title_lengths", "bin", "n", "lo", "hi"),
        *wide("summary_lengths", "bin", "n", "lo", "hi"),
        long("categories", F.col("category"), n),
        long("samples", F.concat_ws("|", *shown), F.lit(1)),
        *wide("sources", "source", "n", "pct"),
        long("authors", F.col("author"), n),
        long("domains", F.col("domain"), n),
        *wide("completeness", None, "total", "complete", "completeness", "categorization_rate"),
        long("completeness", F.lit("suitable"), F.col("suitable").cast("int")),
    ]
    return reduce(DataFrame.union, parts)


@query(
    "f11_f12_run_stamps",
    """SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS midnight,
          strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events""",
)
def _(t):
    """The run's day and instant, taken from each event's time."""
    now = F.col("ts")
    midnight = F.date_format(dates.today(now), "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", midnight.alias("midnight"), dates.iso_now(now).alias("iso"))
