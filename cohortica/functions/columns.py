"""Column expressions and schema helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters stripped from headers and cells, in natural order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Texts read as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def ref(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def split_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric names, other names) in schema order; booleans count as categorical."""
    fields = [f for f in df.schema.fields if f.name not in leave_out]
    numeric = [f.name for f in fields if is_numeric(f.dataType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def as_double(name: str) -> Column:
    """Value as double with NaN turned into null."""
    value = ref(name).cast("double")
    return F.when(~F.isnan(value), value)


def melt_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., column, value) of numeric columns, nulls left out."""
    wide = df.select(*[ref(k) for k in keep], *[as_double(c).alias(c) for c in cols])
    return wide.unpivot(
        [ref(k) for k in keep], [ref(c) for c in cols], "column", "value"
    ).where(F.col("value").isNotNull())


def melt_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., column, value) with values as text; NaN is null and both zeros are one value."""
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        value = ref(c)
        if kinds[c] in ("double", "float"):
            value = F.when(~F.isnan(value), value + F.lit(0.0).cast(kinds[c]))
        return value.cast("string")

    wide = df.select(*[ref(k) for k in keep], *[text(c).alias(c) for c in cols])
    return wide.unpivot([ref(k) for k in keep], [ref(c) for c in cols], "column", "value")


def strip_spaces(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def strip_quotes(col: Column) -> Column:
    return F.btrim(col, F.lit('"'))


def strip_cell(col: Column) -> Column:
    """Whitespace first, then quote characters; what is inside the quotes stays."""
    return strip_quotes(strip_spaces(col))


def null_if_token(col: Column) -> Column:
    return F.when(~col.isin(*NULL_TOKENS), col)


def safe_file_name(col: Column) -> Column:
    return F.translate(col, "/\\ \t", "____")


def report_model_name(file_name: Column) -> Column:
    """Model name in a report file name, null for other files."""
    return F.when(file_name.endswith("_report.csv"), F.replace(file_name, F.lit("_report.csv"), F.lit("")))


def threshold_flag(col: Column, threshold: float = 1) -> Column:
    """1 at or above the threshold, else 0; null and NaN give 0."""
    value = col.cast("double")
    return F.when((value >= F.lit(float(threshold))) & ~F.isnan(value), 1).otherwise(0)


def class_name(code: Column, names: Sequence[str]) -> Column:
    """Name of a class code, ``Unknown`` outside the list."""
    listed = F.array(*[F.lit(n) for n in names])
    inside = (code >= 0) & (code < len(names))
    return F.when(inside, F.get(listed, code.cast("int"))).otherwise("Unknown")


def top_probability(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def percent_text(col: Column) -> Column:
    return F.format_string("%.1f%%", col * 100)


def confidence_band(top: Column) -> Column:
    return F.when(top > 0.8, "High").when(top > 0.6, "Medium").otherwise("Low")


def risk_group(name: Column) -> Column:
    """Reading of a predicted outcome. The names and the texts for them."""
    return (
        F.when(name == "Dropout", "Likely to Drop Out")
        .when(name == "Graduate", "Likely to Graduate")
        .otherwise("Likely to Stay Enrolled")
    )


def digamma(n: Column) -> Column:
    """Digamma of a positive number: recurrence up to n + 6, then the asymptotic series."""
    x = n.cast("double")
    shift = sum((1.0 / (x + float(i)) for i in range(1, 6)), 1.0 / x)
    y = x + 6.0
    y2 = 1.0 / (y * y)
    series = F.log(y) - 0.5 / y - y2 * (1.0 / 12 - y2 * (1.0 / 120 - y2 / 252))
    return series - shift


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
