"""Column-level helpers: recodes, flags, fills and renames.

All return Column expressions or apply ``select``/``withColumns`` so they stay
inside whole-stage codegen; none touches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared with the reference data model.
STATUS_MISSING = "X"          # bureau balance: status unknown
STATUS_CLOSED = "C"           # bureau balance: loan closed, recoded to -1
DAYS_SENTINEL = 365243        # DAYS_EMPLOYED placeholder for "not employed"
CATEGORY_MISSING = "XNA"      # encoded missing category
CATEGORY_NOT_APPLICABLE = "XAP"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn float NaN into SQL NULL once, at ingest (NaN poisons avg/max)."""
    fixes = {name: F.nanvl(F.col(name), F.lit(None).cast(dtype))
             for name, dtype in df.dtypes if dtype in ("double", "float")}
    return df.withColumns(fixes) if fixes else df


def recode_status(c: str | Column = "STATUS") -> Column:
    """Bureau status text -> number: X -> NULL, C -> -1, digits -> value."""
    c = col_of(c)
    return (F.when(c == STATUS_CLOSED, F.lit(-1.0))
            .when(c == STATUS_MISSING, F.lit(None).cast("double"))
            .otherwise(c.try_cast("double")))


def flip_sign_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Multiply day counts by -1; the 365243 sentinel becomes -365243 (kept)."""
    return df.withColumns({c: -F.col(c) for c in cols})


def null_sentinel(c: str | Column, sentinel=DAYS_SENTINEL) -> Column:
    """Value, or NULL where it equals the placeholder."""
    c = col_of(c)
    return F.when(c != F.lit(sentinel), c)


def difference_feature(a: str | Column, b: str | Column) -> Column:
    return col_of(a) - col_of(b)


def positive_flag(c: str | Column) -> Column:
    """``x > 0`` where a missing x counts as False (pandas semantics)."""
    return F.coalesce(col_of(c) > 0, F.lit(False))


def binary_label(df: DataFrame, status_col: str = "NAME_CONTRACT_STATUS", positive: str = "Refused",
                 drop: str | None = "Canceled", out: str = "NAME_CONTRACT_STATUS_Refused") -> DataFrame:
    """Drop one status (NULL statuses stay, as in pandas), then 1/0 label."""
    s = F.col(status_col)
    if drop is not None:
        df = df.where(~s.eqNullSafe(F.lit(drop)))
    return df.withColumn(out, F.when(s == positive, 1).otherwise(0).cast("int"))


def exclude_values(c: str | Column, values: Iterable) -> Column:
    """Predicate ``~isin(values)`` that keeps NULLs, like pandas."""
    c = col_of(c)
    return ~c.isin(list(values)) | c.isNull()


def fill_constant(df: DataFrame, cols: Iterable[str], value) -> DataFrame:
    """Replace NULL by a literal; numeric columns get cast to text when the
    literal is text (ANSI mode refuses the implicit mix)."""
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        target = F.col(c)
        if isinstance(value, str) and types[c] != "string":
            target = target.cast("string")
        out[c] = F.coalesce(target, F.lit(value))
    return df.withColumns(out)


def select_roles(df: DataFrame, keep: Iterable[str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    cols = list(keep) if keep is not None else df.columns
    dropped = set(drop)
    return df.select(*[F.col(f"`{c}`") for c in cols if c not in dropped])


def agg_name(prefix: str, column: str, stat: str) -> str:
    """``prefix_column_stat`` with spaces turned into underscores."""
    return f"{prefix}_{column}_{stat}".replace(" ", "_")


def flatten_agg_names(df: DataFrame, prefix: str, renames: Mapping[str, str] | None = None,
                      keys: Iterable[str] = ("SK_ID_CURR",)) -> DataFrame:
    """Prefix every non-key column (``prefix_column_stat``) and apply fixed renames."""
    renames = dict(renames or {})
    keys = set(keys)
    mapping = {c: renames.get(c, f"{prefix}_{c}".replace(" ", "_")) for c in df.columns if c not in keys}
    return df.withColumnsRenamed(mapping)


def recency_filter(c: str | Column = "DAYS_DECISION", days: int = 365) -> Column:
    """Keep rows no older than ``days`` before the application."""
    return col_of(c) >= -days
