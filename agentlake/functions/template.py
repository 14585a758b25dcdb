"""Text templates over columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def render_template(
    df: DataFrame, template: str, columns: dict[str, str], out: str = "rendered"
) -> DataFrame:
    """Replace ``{NAME}`` by ``columns[NAME]``, one placeholder after another.

    The order of ``columns`` matters: text put in by one placeholder is seen by
    the later ones.
    """
    text = F.lit(template)
    for name, column in columns.items():
        value = F.coalesce(F.col(column).cast("string"), F.lit(""))
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return df.withColumn(out, text)
