"""Destination texts: cleaning, route targets and port codes, all as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import stored

# Country -> port -> names, in match order (the port code itself matches first).
PORTS = {
    "DE": {
        "HAM": ["HAMBURG", "HAMBUG", "HH", "FINKENWERD", "FINKENWERDER", "BLEXEN", "ELBE"],
        "BRV": ["BREMERHAVEN", "BREMENHAVEN", "DEBHV", "BHV"],
        "BRE": ["BREMEN"],
        "KEL": ["KIEL"],
        "STA": ["STADE", "STAD"],
        "BRB": ["BRUNSBUETTEL", "BRUNSBUETT"],
        "VTT": ["HIDDENSEE"],
        "WVN": ["WILHELMSHAVEN"],
    },
    "PL": {
        "GDN": ["GDANSK", "GDANK"],
        "GDY": ["GDYNIA", "GYDNIA", "GYDINIA", "GDYNA"],
        "SZZ": ["SZCZECIN", "PLSZCZECIN"],
    },
    "LT": {"KLJ": ["KLAIPEDA"]},
    "SE": {"HAD": ["HALMSTAD"], "NOK": ["NOK"], "AHU": ["AHUS"]},
    "RU": {"KGD": ["KALININGRAD", "KAL"]},
    "DK": {"KOB": ["KOBENHAVN", "COPENHAGEN", "COPENHAGUE", "CPH"]},
    "FI": {"HKO": ["HANKO"]},
    "BE": {"ANR": ["ANR"]},
}

PortRows = Sequence[tuple[int, str, str, str]]


def port_rows(ports: dict[str, dict[str, list[str]]] = PORTS) -> list[tuple[int, str, str, str]]:
    """(priority, country, port, name) in match order."""
    named = [
        (country, port, name)
        for country, by_port in ports.items()
        for port, names in by_port.items()
        for name in [port, *names]
    ]
    return [(i, *row) for i, row in enumerate(named)]


def port_table(spark: SparkSession, rows: PortRows | None = None) -> DataFrame:
    """The port dictionary as a dimension table."""
    return spark.createDataFrame(rows or port_rows(), "priority int, country string, port string, name string")


def clean_destination(dest: Column) -> Column:
    """Upper case, only ``A-Z 0-9 . / \\ > < -``, single separators written as dots, no stray dots."""
    kept = F.regexp_replace(F.upper(dest), r"[^A-Z0-9./\\><-]", "")
    single = F.regexp_replace(kept, r"([./\\><-])\1+", "$1")
    no_lone_dots = F.regexp_replace(single, r"(?<![A-Z0-9])\.(?![A-Z0-9])", "")
    dotted = F.regexp_replace(F.translate(no_lone_dots, "/\\-", "..."), r"\.+", ".")
    return F.nullif(F.trim(dotted, F.lit(".")), F.lit(""))


def route_target(dest: Column) -> Column:
    """The second part of ``A>B...``; other texts as they are."""
    return F.when(F.contains(dest, F.lit(">")), F.trim(F.split_part(dest, F.lit(">"), F.lit(2)))).otherwise(dest)


def is_invalid_destination(dest: Column) -> Column:
    """No letter at all, or just a two-letter country code."""
    return ~dest.rlike("[A-Za-z]") | dest.rlike("^[A-Z]{2}$")


def has_special_characters(text: Column) -> Column:
    return text.rlike("[^A-Za-z0-9]")


def _names_port(text: Column, country: str, names: Sequence[str]) -> Column:
    """A name at an end of the text, next to a dot, or next to the country code.

    Most texts hold none of the names; the plain search rules them out before the pattern is tried.
    """
    any_name = "(?:" + "|".join(re.escape(n) for n in names) + ")"
    placed = text.rlike(rf"(?:\A|\.|{country}){any_name}|{any_name}(?:\z|\.|{country})")
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in names]) & placed


def port_code(text: Column, rows: PortRows | None = None, keep_unmatched: bool = False) -> Column:
    """``CC.PORT`` of the first matching name, else null (or the text itself).

    The dictionary is a fixed short list, so this is one map-side CASE over its ports: no join, no
    shuffle of free texts, no hot destination.
    """
    names: dict[tuple[str, str], list[str]] = {}
    for _, country, port, name in sorted(rows or port_rows()):
        names.setdefault((country, port), []).append(name)

    def code(of: Column) -> Column:
        matched = F.when(F.trim(of) != "", F.coalesce(*[F.when(_names_port(of, country, of_port), F.lit(f"{country}.{port}")) for (country, port), of_port in names.items()]))
        return F.coalesce(matched, of) if keep_unmatched else matched

    # The text is made once for a row: the tests look at the lambda's variable, not at copies of the expression that makes it.
    return F.get(F.transform(F.array(text), code), F.lit(0))


#: Names whose automaton may be broadcast in one block: some 300 bytes each in a task.
NAMES_AT_ONCE = 100_000


def port_codes(df: DataFrame, column: str, ports: DataFrame, out: str = "code", at_once: int = NAMES_AT_ONCE) -> DataFrame:
    """``out``: ``CC.PORT`` of the dictionary row with the smallest priority whose name stands at an end of the text, next to a dot or next to
    its country's code; null if there is none. As :func:`port_code`, for a dictionary table (``priority, country, port, name``) of any length.

    One map-side pass over the texts for each block of ``at_once`` names, in the order of their priorities: a task finds all names of a block
    in a text with one automaton, in time linear in the text and its hits. Texts are not shuffled. Empty names, and names without a country or a port, name nothing.
    """
    usable = ports.where("name <> '' AND country IS NOT NULL AND port IS NOT NULL").groupBy("country", "port", "name").agg(F.min("priority").alias("priority"))
    ranked = stored(usable, "names").orderBy("priority", "country", "port", "name")
    blocks, rows = [], []
    for r in ranked.select("country", "port", "name").toLocalIterator():  # one block at a time
        rows.append(tuple(r))
        if len(rows) == at_once:
            blocks.append(_finder(df.sparkSession, rows)(F.col(column)))
            rows = []
    if rows:
        blocks.append(_finder(df.sparkSession, rows)(F.col(column)))
    return df.withColumn(out, F.coalesce(*blocks) if blocks else F.lit(None).cast("string"))


def _finder(spark: SparkSession, rows: list[tuple[str, str, str]]):
    """A vectorised function from texts to the code of the first of ``rows`` that each names."""
    shared = spark.sparkContext.broadcast(rows)
    state: dict = {}

    def find(texts: pd.Series) -> pd.Series:
        if not state:  # once in a Python worker
            import ahocorasick

            places: dict[str, list[int]] = {}
            for at, (_, _, name) in enumerate(shared.value):
                places.setdefault(name, []).append(at)
            state["automaton"] = ahocorasick.Automaton()
            for name, of_name in places.items():
                state["automaton"].add_word(name, (len(name), of_name))
            state["automaton"].make_automaton()
        return texts.map(lambda text: _first_named(text, state["automaton"], shared.value), na_action="ignore")

    return F.pandas_udf(find, "string")


def _first_named(text: str, automaton, rows: list[tuple[str, str, str]]) -> str | None:
    best = len(rows)
    for last, (length, places) in automaton.iter(text):
        start, end = last + 1 - length, last + 1
        at_end = start == 0 or text[start - 1] == "." or end == len(text) or text[end] == "."
        for at in places:  # ascending
            if at >= best:
                break
            country = rows[at][0]
            if at_end or text.endswith(country, 0, start) or text.startswith(country, end):
                best = at
                break
    return f"{rows[best][0]}.{rows[best][1]}" if best < len(rows) and text.strip() else None


def port_listing(ports: DataFrame) -> DataFrame:
    """Every name with its code; a name listed twice takes the later code."""
    code = F.concat_ws(".", "country", "port")
    return ports.groupBy("name").agg(F.max_by(code, F.col("priority")).alias("code"))


def port_violations(ports: DataFrame) -> DataFrame:
    """Dictionary entries without a country or without any name besides the code."""
    per_port = ports.groupBy("country", "port").agg((F.count("*") - 1).alias("names"))
    no_country = F.col("country").isNull() | (F.trim("country") == "")
    problem = F.when(no_country, "no country").when(F.col("names") == 0, "no names")
    return per_port.withColumn("problem", problem).filter(F.col("problem").isNotNull()).drop("names")
