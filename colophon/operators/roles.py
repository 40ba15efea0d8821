"""Roles: free text cut into parts, spelling made one, grouped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions import text as T

# fixed values: words that make a part a role, and spellings made one, in this order
ROLE_WORDS = (
    r"(?i)(?U)\b(agent|ambassadeur|envoy[eé]|resident|minister|commissaris|consul|secretaris|zaakgelastigde|zaakwaarnemer|charg[eé]|correspondent|"
    r"gedeputeerde|plenipotentiaris|gezant|gevolmachtigde|gemachtigde|geauthoriseerde|lasthebber|orateur|raad|diplomatiek|protector|"
    r"legatiesecretaris|legatieraad|reissecretaris|gezantschapssecretaris|hoofdconsul|oorlogscommissaris)\b"
)
SPELLINGS = [
    (r"(?i)\bextraordinairs\b", "extraordinaris"),
    (r"(?i)\bextraordinans\b", "extraordinaris"),
    (r"(?i)\bextraordinär is\b", "extraordinaris"),
    (r"(?i)\bextraordinar\b", "extraordinaris"),
    (r"(?i)\bminster\b", "minister"),
    (r"(?i)\bplenipotentiaiis\b", "plenipotentiaris"),
    (r"(?i)\bplenipoteniar\b", "plenipotentiaris"),
    (r"(?U)(\w)-\s+(\w)", "$1$2"),
    (r"(?i)^\s*(later|voorlopig)\s+", ""),
    (r"\)\s*$", ""),
    (r"  +", " "),
]
DROPPED = [(r"\([^)]*\)", ""), (r"\b1[0-9]{3}\.?(?U:\b)", ""), (r"\?", ""), (r"^[\s\-–]+", "")]


def clean_role(part: Column) -> Column:
    out = reduce(lambda c, rule: F.regexp_replace(c, *rule), DROPPED, part)
    out = F.regexp_replace(T.strip(out), r"[ \-.]+$", "")
    return T.strip(reduce(lambda c, rule: F.regexp_replace(c, *rule), SPELLINGS, out))


def roles(rows: DataFrame, value: str = "functie", most: int = 120) -> DataFrame:
    """One row per role of a value; values that are too long are data errors."""
    parts = rows.where(F.length(value) <= most).select("*", F.posexplode(F.split(F.col(value), "[,;]")).alias("pos", "part"))
    return parts.withColumn("role", clean_role(F.col("part"))).where((F.col("role") != "") & F.col("role").rlike(ROLE_WORDS)).withColumn("role_key", F.lower("role"))


def role_index(roles_: DataFrame, begin: str = "beginjaar", nr: str = "schutte_nr", last: str = "lemma_id") -> DataFrame:
    """Per role its occurrences and its most common spelling; of equally common ones that of the first holder, by begin and number."""
    year = F.coalesce(F.nullif(F.col(begin), F.lit(0)), F.lit(9999))
    spelt = roles_.groupBy("role_key", "role").agg(F.count("*").alias("n"), F.min(F.struct(year.alias("y"), F.col(nr).alias("nr"), F.col(last).alias("k"), F.col("pos"))).alias("first"))
    best = F.min_by("role", F.struct((-F.col("n")).alias("n"), F.col("first"), F.col("role")))
    return spelt.groupBy("role_key").agg(F.sum("n").alias("n"), best.alias("role"), F.min("first.y").alias("first_year"))


def role_persons(roles_: DataFrame, begin: str = "beginjaar", nr: str = "schutte_nr", last: str = "lemma_id") -> DataFrame:
    """The persons of every role in the order of first year (unknown last) and number; one row a person, so a common role is no single row."""
    year = F.nullif(F.col(begin), F.lit(0))
    place = F.row_number().over(Window.partitionBy("role_key").orderBy(F.coalesce(year, F.lit(9999)), nr, last, "pos"))
    return roles_.withColumn("place", place)
