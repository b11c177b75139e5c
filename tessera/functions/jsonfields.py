"""Field access on parsed JSON (VARIANT) with the reference's falsy rules.

A raw post is parsed once (``try_parse_json``). ``extract`` then pulls each
field out once as a small VARIANT plus its type name, in its own projection;
the rule functions below work on those two columns, which keeps the generated
code of the final projection small (one variant lookup per field, not one
per rule).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extract(df: DataFrame, vcol: str, fields: dict[str, str]) -> DataFrame:
    """Add ``_f_<name>`` (field as VARIANT) and ``_t_<name>`` (its type name)."""
    df = df.withColumns({f"_f_{n}": F.try_variant_get(F.col(vcol), p, "variant")
                         for n, p in fields.items()})
    df = df.withColumns({f"_t_{n}": F.schema_of_variant(F.col(f"_f_{n}"))
                         for n in fields})
    return df.withColumns({f"_s_{n}": F.try_variant_get(F.col(f"_f_{n}"), "$", "string")
                           for n in fields})


def fld(name: str) -> tuple[Column, Column, Column]:
    return F.col(f"_f_{name}"), F.col(f"_t_{name}"), F.col(f"_s_{name}")


def truthy(f: Column, t: Column, s: Column | None = None) -> Column:
    """Python truthiness: missing, null, false, 0, '', [] and {} are falsy.
    Containers are judged from the type name alone ('OBJECT<>' is {},
    'ARRAY<VOID>' is [] or an all-null array)."""
    s = F.try_variant_get(f, "$", "string") if s is None else s
    return (F.when(t.isNull() | t.isin("NULL", "VOID"), F.lit(False))
            .when(t == "STRING", s != "")
            .when(t == "BOOLEAN", s == "true")
            .when(t == "ARRAY<VOID>", F.size(F.try_variant_get(f, "$", "array<variant>")) > 0)
            .when(t.startswith("ARRAY"), F.lit(True))
            .when(t.startswith("OBJECT"), t != "OBJECT<>")
            .otherwise(F.coalesce(F.try_variant_get(f, "$", "double") != 0, F.lit(True))))


def text_or(f: Column, t: Column, s: Column | None = None, default: str = "") -> Column:
    """``str(x)`` when x is truthy, else the default (``x or ''``)."""
    s = F.try_variant_get(f, "$", "string") if s is None else s
    return F.when(truthy(f, t, s), s).otherwise(F.lit(default))


def text_or_null(f: Column, t: Column, s: Column | None = None) -> Column:
    s = F.try_variant_get(f, "$", "string") if s is None else s
    return F.when(truthy(f, t, s), s)


def count_or_zero(f: Column, t: Column, s: Column | None = None) -> Column:
    """``x or 0`` stored into an integer column (fractions round, as a DB cast)."""
    n = F.round(F.try_variant_get(f, "$", "decimal(38,6)")).cast("bigint")
    return F.when(truthy(f, t, s), F.coalesce(n, F.lit(0).cast("bigint"))) \
        .otherwise(F.lit(0).cast("bigint"))


def string_array(f: Column, t: Column, s: Column | None = None) -> Column:
    """``x or []`` as ARRAY<STRING>; never NULL."""
    empty = F.array().cast("array<string>")
    return F.when(truthy(f, t, s), F.coalesce(F.try_variant_get(f, "$", "array<string>"), empty)) \
        .otherwise(empty)


def object_or_null(f: Column, t: Column, s: Column | None = None) -> Column:
    """Sub-document kept only when truthy (non-empty), else NULL."""
    return F.when(truthy(f, t, s), f)
