"""Country of a tweet from its place or from its author's free-text location."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillmill.functions.text import tokens_no_punct

# Postal abbreviations of the 50 states.
US_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO "
    "MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
UNITED_STATES = "United States"
UNITED_KINGDOM = "United Kingdom"
UK = "UK"


def _by_name(locations: DataFrame, countries: DataFrame) -> DataFrame:
    """``loc, by_name``: the *last* country of the list whose name occurs in the text.

    "Occurs" is equality with one of the text's substrings of the lengths that names have,
    so no pairs are compared.
    """
    lengths = countries.agg(F.collect_set(F.length("name")).alias("lengths")).scalar()
    bound = locations.withColumn("lengths", lengths)

    def substrings(n):
        return F.transform(F.sequence(F.lit(1), F.length("loc") - n + 1), lambda i: F.substring(F.col("loc"), i, n))

    fitting = F.filter("lengths", lambda n: n <= F.length("loc"))
    parts = bound.select("loc", F.explode(F.array_distinct(F.flatten(F.transform(fitting, substrings)))).alias("name"))
    last = parts.join(countries.select("name", "ord"), "name").groupBy("loc").agg(F.max("ord").alias("ord"))
    return last.join(countries.select("ord", F.col("name").alias("by_name")), "ord").select("loc", "by_name")


def _by_word(locations: DataFrame, countries: DataFrame, states) -> DataFrame:
    """``loc, in_state, by_code``: a state abbreviation among the words, and the first code.

    Codes rank by the list: alpha-2 before alpha-3 of a country, and ``UK`` right after
    the first country's alpha-2.
    """
    words = locations.select("loc", F.explode(F.array_distinct(tokens_no_punct(F.col("loc")))).alias("word"))
    codes = countries.select(F.col("alpha2").alias("word"), (F.col("ord") * 3).alias("rank"), "name").unionByName(
        countries.select(F.col("alpha3").alias("word"), (F.col("ord") * 3 + 2).alias("rank"), "name")
    )
    uk = countries.agg(F.min("ord").alias("ord")).where("ord is not null")
    codes = codes.unionByName(uk.select(F.lit(UK).alias("word"), (F.col("ord") * 3 + 1).alias("rank"), F.lit(UNITED_KINGDOM).alias("name")))
    first = words.join(codes.drop("name"), "word").groupBy("loc").agg(F.min("rank").alias("rank"))
    coded = first.join(codes.drop("word").distinct(), "rank").select("loc", F.col("name").alias("by_code"))
    in_state = words.where(F.col("word").isin(list(states))).select("loc").distinct().withColumn("in_state", F.lit(True))
    return coded.join(in_state, "loc", "full")


def resolve_locations(locations: DataFrame, countries: DataFrame, states: list[str] | tuple[str, ...] = tuple(US_STATES)) -> DataFrame:
    """``loc, country`` of the distinct texts ``loc`` that name a country.

    In this order: the last country whose name occurs in the text; the United States
    when a word is a state abbreviation; the first of the list's codes among the words.
    ``countries`` is ``(ord, name, alpha2, alpha3)`` of any length.
    """
    named, worded = _by_name(locations, countries), _by_word(locations, countries, states)
    both = named.join(worded, "loc", "full")
    by_state = F.when(F.col("in_state"), F.lit(UNITED_STATES))
    return both.select("loc", F.coalesce("by_name", by_state, "by_code").alias("country"))


def tweet_location(df: DataFrame, countries: DataFrame, states=tuple(US_STATES), name: str = "location") -> DataFrame:
    """Add the country column to parsed tweets (columns ``place`` and ``user``).

    A tweet with a place never falls through to the author's location, even when the
    place has no country. Each distinct location is resolved once.
    """
    asked = df.where(F.col("place").isNull() & (F.length("user.location") > 0)).select(F.col("user.location").alias("loc")).distinct()
    found = resolve_locations(asked, countries, states).select(F.col("loc").alias("_loc"), F.col("country").alias("_country"))
    wanted = F.when(F.col("place").isNull(), F.col("user.location"))
    joined = df.withColumn("_wanted", wanted).join(found, F.col("_wanted") == F.col("_loc"), "left")
    country = F.when(F.col("place").isNotNull(), F.col("place.country")).otherwise(F.col("_country"))
    return joined.withColumn(name, country).drop("_wanted", "_loc", "_country")
