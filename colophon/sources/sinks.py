"""Sinks.  Everything is written in parallel by partition; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions import text as T


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_search_index(df: DataFrame, path: str) -> None:
    """Compact rows, null members left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def lemma_xml(lines: DataFrame, meta: DataFrame, order: str, text: str = "text") -> DataFrame:
    """One XML document an entry: its attributes, and its typed lines in order.  Notes and page heads too; citations become links."""
    body = F.when(F.col("type") == "bronnen", T.link_citations(T.escape_xml(F.col(text)))).otherwise(T.escape_xml(F.col(text)))
    one = F.concat(F.lit('<line type="'), F.col("type"), F.lit('">'), body, F.lit("</line>"))
    docs = lines.groupBy("corpus", "schutte_nr").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), one.alias("x")))), lambda r: r["x"]), "\n").alias("body"))
    shown = {"schuttenr": F.col("schutte_nr"), "corpus": F.col("corpus"), "name": F.col("name"), "givenname": F.col("givenname"), "begin": F.col("beginjaar"), "eind": F.col("eindjaar"), "functie": F.col("functie")}
    head = F.concat(F.lit("<lemma "), T.xml_attributes(**shown), F.lit(">\n"))
    return docs.join(meta, ["corpus", "schutte_nr"], "left").select("corpus", "schutte_nr", F.concat(head, F.col("body"), F.lit("\n</lemma>")).alias("xml"))


def write_xml(docs: DataFrame, path: str) -> None:
    """Documents in a folder per corpus, a record a file row (they hold line feeds, so Parquet keeps them whole)."""
    docs.write.mode("overwrite").partitionBy("corpus").parquet(path)


def corpus_xml(lines: DataFrame, part: list[str], order: str) -> DataFrame:
    """Pages as elements with their lines in order."""
    one = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), F.col("text").alias("t")))), lambda r: T.escape_xml(r["t"]))
    return lines.groupBy(*part).agg(F.array_join(one, "<br>").alias("body")).withColumn("xml", F.concat(F.lit('<page number="'), F.col(part[-1]).cast("string"), F.lit('">'), F.col("body"), F.lit("</page>"))).drop("body")


def tagged_lines(lines: DataFrame, starts: DataFrame, seq: str, text: str = "text") -> DataFrame:
    """Lines in which a start was located (``schutte_nr``, and ``found``, its form there), with the start wrapped in its mark.

    Of several starts on a line the least number is wrapped.  A start that runs over the line's end, or whose blanks differ, wraps the line from where it
    is sure to begin: the whole of it.
    """
    first = starts.where(F.col(seq).isNotNull()).groupBy(seq).agg(F.min(F.struct("schutte_nr", "found")).alias("_first"))
    line, found = F.col(text), F.col("_first.found")
    at = F.instr(line, found)
    mark = F.concat(F.lit('<start schuttenr="'), F.col("_first.schutte_nr").cast("string"), F.lit('">'))
    inside = F.concat(F.substring(line, F.lit(1), at - 1), mark, found, F.lit("</start>"), F.substring(line, at + F.length(found), F.length(line)))
    tagged = F.when(F.col("_first").isNull(), line).when(at > 0, inside).otherwise(F.concat(mark, line, F.lit("</start>")))
    return lines.join(first, seq, "left").withColumn(text, tagged).drop("_first")
