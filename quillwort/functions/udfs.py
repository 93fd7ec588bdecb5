"""Functions for SQL text: Arrow UDFs of the normalisations, and a table function for LATERAL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.skills import SkillRules, masked


def register(spark: SparkSession) -> list[str]:
    """Register Arrow UDFs of the same names for SQL text.

    DataFrame code should call the column functions, which stay on the JVM. A name in SQL text has to be a
    registered function, and Spark registers Python ones only; these evaluate the expressions of the same meaning.
    """
    import pandas as pd

    from ..operators.skills import fold

    plain = {
        "job_normalize": lambda x: " ".join(fold(x or "").replace("#", " ").replace("+", " ").split()),
        "job_normalize_tech": lambda x: fold(x or ""),
    }

    def make(f):
        @F.pandas_udf("string")
        def run(texts: pd.Series) -> pd.Series:
            return texts.map(f)

        return run

    for name, f in plain.items():
        spark.udf.register(name, make(f))
    return list(plain)


def register_mentions(spark: SparkSession, rules: SkillRules, name: str = "skill_mentions") -> None:
    """A table function of a text: one row (skill, place) for each alias that it names."""
    aliases = [(s, f" {a} ") for s, a, _, _ in rules.aliases]

    @F.udtf(returnType="skill string, place int")
    class Mentions:
        def eval(self, text: str):
            padded = f" {masked(text or '', rules)[1]} "
            for skill, alias in aliases:
                if (at := padded.find(alias)) >= 0:
                    yield skill, at

    spark.udtf.register(name, Mentions)
