"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from actloom.runtime import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: whitespace as Unicode has it, for an engine whose \s is ASCII
WS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sclean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{WS}+', ' ', 'g'))"


def swords(c: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({c}, ''), '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)?'), lambda x: lower(x))"


def sfirst(c: str, pattern: str, group: int = 1) -> str:
    """The group of the first match, or null."""
    quoted = pattern.replace("'", "''")
    return f"nullif(regexp_extract({c}, '{quoted}', {group}), '')"


#: quotes that may stand before or behind a text
Q = "[‘''" + '"]'


def _nested(c: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        c = f"regexp_replace({c}, '{pattern}', {by})"
    return c


def sstrip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def stab(c: str) -> str:
    """A tab behind a leading marker."""
    q = "[‘''" + '"' + "“”]?"
    return _nested(sstrip(f"replace(coalesce({c}, ''), chr(160), ' ')"), *[(rf"^({q}{m}){WS}+", r"'\1' || chr(9)") for m in (r"\(\d+\)", r"\d+[A-Za-z]?\.", r"(?i:\([a-z]+\))")])


def sunquoted(c: str) -> str:
    """Outer quotes off, a doubled final stop made one."""
    inner = _nested(sstrip(f"coalesce({c}, '')"), (f"^{Q}+", "''"), (rf"[’\"'']{WS}*;?$", "''"), (r"[’\"'']\.$", "'.'"), (rf"[’\"'']+{WS}*;{WS}*$", "''"), (r"(^|[^.])\.\.$", r"'\1.'"))
    return sstrip(inner)


def sanchorless(c: str) -> str:
    steps = (rf"(?i){WS}*\[\[SRC:[^\]]+\]\]", r"(?i)\bSRC:[A-Za-z0-9_.-]+\b", rf"(?i)\bsrc{WS}+art{WS}+\d+[A-Za-z]?(?:{WS}+\d+[A-Za-z]?)?\b")
    for x in steps:
        c = f"regexp_replace(coalesce({c}, ''), '{x}', '', 'g')"
    return sclean(c)


def steps(source: str, *columns: tuple[str, str]) -> str:
    """``source`` with one column more at each step; later steps see those before."""
    for name, expr in columns:
        source = f"SELECT *, {expr} AS {name} FROM ({source})"
    return source


def sdistinct(c: str) -> str:
    """The distinct elements of a list in order of first occurrence."""
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


def query(sql: str | None = None):  # noqa: ANN201
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: tables whose rows take work: read as few tasks, they are spread over the cores
WORKED = frozenset(("amendment_analysis", "documents", "footnotes", "text_blocks"))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(df) if name in WORKED else df
