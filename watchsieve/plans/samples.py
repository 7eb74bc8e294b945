"""Screening inputs and a watch list read out of the driver's tables, as plans and as SQL views.

documents give persons (the first two words of a text), part gives organisations (a name and a form), customer and supplier
give addresses, documents' phone numbers give phones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScreeningConfig
from ..functions import tables
from ..sources.inputs import normalized
from ..sources.watchlist import WatchList, prepared
from ..workers import find_library

CONFIG = ScreeningConfig()
FORMS = ("LLC", "Ltd", "Inc.", "GmbH", "Company", "Holdings", "L.L.C.", "Corporation")
ORG_BASE = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_library(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PHONE_IN_TEXT = r"\+1 \(\d{3}\) \d{3}-\d{4}"
#: The first two words of a text that have a letter, found from its beginning alone; other characters are then taken out of them.
FIRST, SECOND = r"^[^A-Za-z]*([A-Za-z][^ ]*)", r"^[^A-Za-z]*[A-Za-z][^ ]* [^A-Za-z]*([A-Za-z][^ ]*)"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who the documents name: doc_id, fn and ln, and the first phone number in the text, empty without one."""
    one = lambda pattern: F.regexp_replace(F.regexp_extract("text", pattern, 1), "[^A-Za-z]", "")
    who = table(spark, sf_dir, "documents").select("doc_id", F.struct(one(FIRST).alias("fn"), one(SECOND).alias("ln"), F.regexp_extract("text", f"({PHONE_IN_TEXT})", 1).alias("phone")).alias("p"))
    return who.select("doc_id", "p.fn", "p.ln", "p.phone").filter("fn <> '' AND ln <> ''")


PEOPLE = rf"""w AS (SELECT doc_id, regexp_replace(regexp_extract(text, '{FIRST}', 1), '[^A-Za-z]', '', 'g') AS fn, regexp_replace(regexp_extract(text, '{SECOND}', 1), '[^A-Za-z]', '', 'g') AS ln, text FROM documents),
people AS (SELECT doc_id, fn, ln, text FROM w WHERE fn <> '' AND ln <> '')"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("p_partkey") % len(FORMS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", form).alias("name"))


PARTS = f"parts AS (SELECT p_partkey, p_name || ' ' || {list(FORMS)}[p_partkey % {len(FORMS)} + 1] AS name FROM part)"


def _places(df: DataFrame, spark: SparkSession, sf_dir: str, nation: str, key: str) -> DataFrame:
    where = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows
    return df.join(F.broadcast(where), F.col(nation) == F.col("n_nationkey")).select(
        F.col(key).cast("bigint").alias("id"), F.concat((F.col(key) % 90).cast("string"), F.lit(" "), "n_name", F.lit(" St")).alias("address1"), F.concat(F.lit("Apt "), (F.col(key) % 7).cast("string")).alias("address2"),
        F.concat(F.lit("C"), F.upper(F.substring(F.md5(F.col("n_name").cast("binary")), 1, 7))).alias("city"), F.element_at(F.array(*map(F.lit, ("CA", "tx", "Ontario", "N.Y."))), (F.col(key) % 4 + 1).cast("int")).alias("region"),
        F.lpad((F.col(key) % 1000).cast("string"), 5, "0").alias("postal_code"), F.col("r_name").alias("country"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey", "c_custkey")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(table(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey", "s_suppkey")


def _places_sql(name: str, source: str, nation: str, key: str) -> str:
    return f"""{name} AS (SELECT {key} AS id, ({key} % 90) || ' ' || n_name || ' St' AS address1, 'Apt ' || ({key} % 7) AS address2, 'C' || upper(substr(md5(n_name), 1, 7)) AS city,
  ['CA', 'tx', 'Ontario', 'N.Y.'][{key} % 4 + 1] AS region, lpad(({key} % 1000)::VARCHAR, 5, '0') AS postal_code, r_name AS country
  FROM {source} JOIN nation ON {nation} = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


PLACES = _places_sql("customers", "customer", "c_nationkey", "c_custkey") + ",\n" + _places_sql("suppliers", "supplier", "s_nationkey", "s_suppkey")

def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phone number of each document that has one."""
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("text", f"({PHONE_IN_TEXT})", 1).alias("phone")).filter("phone <> ''")


PHONES = rf"phones AS (SELECT * FROM (SELECT doc_id, regexp_extract(text, '({PHONE_IN_TEXT})', 1) AS phone FROM documents) WHERE phone <> '')"


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir).filter("doc_id % 5 >= 2").withColumn("phone", F.nullif("phone", F.lit("")))
    return rows.select(F.col("doc_id").alias("record_id"), F.lit("Individual").alias("entity_type"), _null().alias("entity_name"), F.col("fn").alias("first_name"), _null().alias("middle_name"), F.col("ln").alias("last_name"), "phone", F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("external_id"))


def org_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).filter("p_partkey % 97 > 1").select((F.col("p_partkey") + ORG_BASE).alias("record_id"), F.lit("Entity").alias("entity_type"), F.col("name").alias("entity_name"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("external_id"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons, organisations, and persons' addresses: those of the customer of the same number."""
    place = customers(spark, sf_dir).withColumnRenamed("id", "record_id").dropDuplicates(["record_id"])  # so that queries without addresses need no join
    rows = person_records(spark, sf_dir).unionByName(org_records(spark, sf_dir), allowMissingColumns=True)
    return normalized(rows.join(place, "record_id", "left"), CONFIG)


def watch(spark: SparkSession, sf_dir: str) -> WatchList:
    who, company = people(spark, sf_dir), parts(spark, sf_dir)
    place = suppliers(spark, sf_dir)
    note = F.when(F.col("doc_id") % 25 == 0, F.concat(F.lit("Linked to: "), "fn", F.lit(" "), "ln", F.lit("; Phone: "), F.coalesce("phone", F.lit("none")))).when(F.col("phone").isNotNull(), F.concat(F.lit("Tel. "), "phone"))
    their = phones(spark, sf_dir).withColumn("doc_id", F.col("doc_id") - 2).dropDuplicates(["doc_id"])  # the number of an input person
    persons = who.filter("doc_id % 5 = 0").drop("phone").join(their, "doc_id", "left").select(F.col("doc_id").alias("uid"), F.col("fn").alias("firstName"), F.col("ln").alias("lastName"), F.lit("Individual").alias("sdnType"), note.alias("remarks"))
    companies = company.filter("p_partkey % 97 = 0").select((F.col("p_partkey") + ORG_BASE).alias("uid"), _null().alias("firstName"), F.col("name").alias("lastName"), F.lit("Entity").alias("sdnType"), F.concat(F.lit("Linked To: "), "name", F.lit("; x")).alias("remarks"))
    strong = F.when(F.col("aka_uid") % 2 == 0, F.lit("strong")).otherwise(F.lit("weak"))
    aka = who.filter("doc_id % 5 = 1").select(F.col("doc_id").alias("aka_uid"), (F.col("doc_id") - 1).alias("owner"), F.col("fn").alias("firstName"), F.col("ln").alias("lastName")).union(
        company.filter("p_partkey % 97 = 1").select((F.col("p_partkey") + ORG_BASE).alias("aka_uid"), (F.col("p_partkey") + ORG_BASE - 1).alias("owner"), _null(), "name"))
    address = place.select(F.col("id").alias("addr_uid"), (F.col("id") * 5).alias("owner"), "address1", "address2", "city", "region", "postal_code", "country")
    made = {
        "sdnEntry": persons.union(companies), "akaList": aka.select(F.col("aka_uid").alias("uid"), strong.alias("category"), "firstName", "lastName"), "sdnEntry_akaList": aka.select(F.col("owner").alias("sdnEntry_uid"), F.col("aka_uid").alias("akaList_uid")),
        "addressList": address.select(F.col("addr_uid").alias("uid"), "address1", "address2", _null().alias("address3"), "city", F.col("region").alias("stateOrProvince"), F.col("postal_code").alias("postalCode"), "country"),
        "sdnEntry_addressList": address.select(F.col("owner").alias("sdnEntry_uid"), F.col("addr_uid").alias("addressList_uid")),
    }
    return prepared(made, CONFIG)


def nm(x: str) -> str:
    """SQL that normalizes."""
    return rf"coalesce(upper(trim(regexp_replace(regexp_replace({x}, '[^A-Za-z0-9\s\-#]', '', 'g'), '\s+', ' ', 'g'))), '')"


def ph(x: str) -> str:
    return f"replace({x}, 'PH', 'F')"


def jw(a: str, b: str) -> str:
    return f"round(jaro_winkler_similarity({a}, {b}) * 100, 2)"


def mapped(x: str, values: dict[str, str]) -> str:
    keys, full = ("[" + ", ".join("'" + v.replace("'", "''") + "'" for v in part) + "]" for part in (values.keys(), values.values()))
    return f"coalesce(map({keys}, {full})[{x}], {x})"


def state(x: str) -> str:
    return mapped(nm(x), tables.STATES)


def country(x: str) -> str:
    return mapped(nm(x), tables.COUNTRIES)


def address(x: str) -> str:
    """Enough for the sample lines: their abbreviations are not the first word, apart from Apt."""
    return nm(rf"regexp_replace(regexp_replace({x}, '(?i)\bst$', 'Street'), '(?i)\bapt\b', 'Apartment')")


_SUFFIX = {a: f for a, f, p in reversed(tables.ENTITY_TYPES) if p in ("SUFFIX", "BOTH")}


def org(x: str) -> str:
    up = f"replace(upper({x}), 'PH', 'F')"
    last = rf"regexp_extract({up}, '(\S+)$', 1)"
    key = f"replace({last}, '.', '')"
    full = f"map({[*_SUFFIX]}, {[*_SUFFIX.values()]})[{key}]"
    return ph(nm(rf"CASE WHEN {full} IS NULL THEN {up} ELSE regexp_replace({up}, '\S+$', {full}) END"))


def _phrases() -> tuple[list[str], list[str]]:
    canon: dict[str, str] = {}
    for a, f, p in tables.ENTITY_TYPES:
        if p in ("SUFFIX", "BOTH"):
            canon.setdefault(f.upper(), f.upper())
            canon[a] = f.upper()
    return [*canon], [*canon.values()]


def gate(pairs: str, threshold: float = 0.85) -> str:
    """SQL views s1 to s4 over a view with a and b: the words, counts and gates of each pair. Prefixes are not in the samples."""
    short, full = _phrases()
    form = "(?:^| )(" + "|".join(short) + ")$"
    stop = str(list(tables.STOP_WORDS))
    hit = lambda x, y: f"len([p FOR p IN {x} IF len([q FOR q IN {y} IF jaro_winkler_similarity(p, q) >= {threshold}]) > 0])"
    return f"""s1 AS (SELECT *, [x FOR x IN string_split(lower(a), ' ') IF NOT list_contains({stop}, x)] AS wa, [x FOR x IN string_split(lower(b), ' ') IF NOT list_contains({stop}, x)] AS wb,
  regexp_extract(a, '{form}', 1) AS fa, regexp_extract(b, '{form}', 1) AS fb FROM (SELECT DISTINCT a, b FROM {pairs})),
s2 AS (SELECT *, len(wa)::INT AS src_words, len(wb)::INT AS sdn_words, {hit("wa", "wb")}::INT AS matched, {jw("lower(a)", "lower(b)")} AS full_jw,
  fa <> '' AND fb <> '' AND map({short}, {full})[fa] = map({short}, {full})[fb] AS same,
  [x FOR x IN string_split(lower(regexp_replace(a, '{form}', '')), ' ') IF x <> ''] AS ra, [x FOR x IN string_split(lower(regexp_replace(b, '{form}', '')), ' ') IF x <> ''] AS rb FROM s1),
s3 AS (SELECT *, CASE WHEN same THEN len(ra) = 0 OR {hit("ra", "rb")} >= CASE WHEN len(ra) <= 2 THEN len(ra) ELSE len(ra) - 1 END END AS type_gate FROM s2),
s4 AS (SELECT a, b, src_words, sdn_words, matched, full_jw, type_gate, coalesce(type_gate, abs(src_words - sdn_words) <= 1 AND abs(src_words - matched) <= 1 AND full_jw >= 90) AS passed FROM s3)"""
