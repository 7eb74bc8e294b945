"""Near misses made from listed names, to test a run with; the same seed gives the same rows."""

from __future__ import annotations

import random
import string
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jw_one
from ..functions.text import col

CATEGORIES = ("P", "PAKA", "E", "EAKA", "LT")
LOW, HIGH = 0.75, 0.99


def perturbed_one(name: str, seed: int, low: float = LOW, high: float = HIGH, tries: int = 200) -> str:
    """name with one to four letters of its last two thirds changed, so that its Jaro-Winkler similarity is in range; unchanged if none of the tries is."""
    rng = random.Random(zlib.crc32(name.encode()) * 1_000_003 + seed)
    places = [i for i, x in enumerate(name) if x.isalpha() and i >= len(name) // 3]
    for _ in range(tries if places else 0):
        out = list(name)
        for i in rng.sample(places, min(len(places), rng.randint(1, 4))):
            out[i] = rng.choice([x for x in (string.ascii_uppercase if name[i].isupper() else string.ascii_lowercase) if x != name[i]])
        if low <= jw_one(name, made := "".join(out)) <= high:
            return made
    return name


def perturbed(c: Column | str, seed: int = 0) -> Column:
    def batch(names: pd.Series) -> pd.Series:
        return pd.Series([None if n is None else perturbed_one(n, seed) for n in names])

    return F.pandas_udf(batch, "string")(col(c))


def generate(entries: DataFrame, akas: DataFrame, remarks: DataFrame, addresses: DataFrame, n: int, seed: int = 0, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """n records in equal parts of the categories (the rest goes to the first): persons, their other names, entities, their other names, and linked parties; about a third with a perturbed city and country of the same party."""
    none = F.lit(None).cast("string")
    person, company = F.lower("sdn_type") == "individual", F.lower("sdn_type") == "entity"
    pools = {
        "P": entries.filter(person & F.col("first_name").isNotNull()).select("uid", F.col("first_name").alias("fn"), F.col("last_name").alias("ln"), none.alias("en")),
        "PAKA": akas.filter(person & F.col("first_name").isNotNull()).select("uid", F.col("first_name").alias("fn"), F.col("last_name").alias("ln"), none.alias("en")),
        "E": entries.filter(company).select("uid", none.alias("fn"), none.alias("ln"), F.col("last_name").alias("en")),
        "EAKA": akas.filter(company).select("uid", none.alias("fn"), none.alias("ln"), F.col("last_name").alias("en")),
        "LT": remarks.select("uid", none.alias("fn"), none.alias("ln"), F.col("text").alias("en")),
    }
    share, rest = divmod(n, len(categories))
    parts = []
    for k, name in enumerate(categories):
        few = pools[name].orderBy(F.xxhash64("uid", F.coalesce("fn", F.lit("")), F.coalesce("ln", F.lit("")), F.coalesce("en", F.lit("")), F.lit(seed)), "uid").limit(share + (rest if k == 0 else 0))
        nth = F.row_number().over(Window.partitionBy(F.lit(name)).orderBy("uid", F.coalesce("ln", "en")))  # over the limit above
        parts.append(few.withColumn("external_id", F.concat(F.lit(f"DUMMY-{name}-"), F.lpad(nth.cast("string"), 5, "0"))))
    some = reduce(DataFrame.union, parts)
    place = addresses.groupBy("uid").agg(F.min(F.struct("city", "country")).alias("a"))
    with_place = some.join(place, "uid", "left").withColumn("keep", F.pmod(F.xxhash64("external_id", F.lit(seed)), F.lit(10)) < 3)
    return with_place.select(
        F.when(F.col("en").isNull(), F.lit("Individual")).otherwise(F.lit("Entity")).alias("entity_type"), perturbed("en", seed).alias("entity_name"), perturbed("fn", seed).alias("first_name"), perturbed("ln", seed).alias("last_name"),
        F.when(F.col("keep"), perturbed("a.city", seed)).alias("city"), F.when(F.col("keep"), perturbed("a.country", seed)).alias("country"), "external_id", F.lit("DUMMY").alias("entity_num"), F.col("uid").alias("target_uid"),
    )


def screening_rows(made: DataFrame) -> DataFrame:
    """made: of generate. The rows as a screening table holds them, marked as dummies; a person's label is the contact's id, an entity's that of the entity."""
    person, null = F.col("entity_type") == "Individual", F.lit(None).cast("string")
    return made.select(
        F.current_timestamp().alias("Upload_Date"), F.when(~person, F.col("entity_name")).alias("ENTITY_NAME"), F.lit("DUMMY").alias("ENTITY_NUM"), F.when(person, F.col("first_name")).alias("FIRST_NAME"), null.alias("MIDDLE_NAME"), F.when(person, F.col("last_name")).alias("LAST_NAME"),
        *[null.alias(f"ADDRESS{k}") for k in (1, 2, 3)], F.col("city").alias("CITY"), null.alias("STATE"), null.alias("POSTAL_CODE"), F.col("country").alias("COUNTRY"),
        F.when(person, F.col("external_id")).alias("Contact_ID"), F.when(~person, F.col("external_id")).alias("Entity_ID"),
    )
