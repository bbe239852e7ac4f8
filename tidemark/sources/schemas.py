"""The tables of FIXTURES.md §1, declared once: columns, types, what may be NULL, domains, ranges and keys.

A declaration gives the Spark schema and the rules that a row must satisfy, as
SQL that Spark and other engines read alike.  Constraint checks (A12, K9) and guarded writes
take their rules from here.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A column; ``least`` and ``most`` bound it (``most`` may name another column), ``values`` lists its domain."""

    name: str
    kind: str
    nullable: bool = False
    values: tuple[str, ...] = ()
    least: int | None = None
    most: str | None = None
    positive: bool = False


@dataclass(frozen=True)
class Rule:
    """``sql`` is true or NULL (as for a CHECK) where a row is well."""

    name: str
    kind: str  # not_null | check
    sql: str

    @property
    def holds(self) -> Column:
        return F.expr(self.sql)


@dataclass(frozen=True)
class TableType:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    #: Columns that are NULL together or not at all.
    paired: tuple[tuple[str, str], ...] = ()
    #: Columns of which the first is at most the second.
    ordered: tuple[tuple[str, str], ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"{f.name} {f.kind}" for f in self.fields)

    def rules(self) -> list[Rule]:
        """The rules of rows, in the order of the columns; the key's uniqueness is no rule of a row."""
        out = [Rule(f"{f.name} is set", "not_null", f"{f.name} IS NOT NULL") for f in self.fields if not f.nullable]
        for f in self.fields:
            if f.values:
                listed = ", ".join(f"'{v}'" for v in f.values)
                out.append(Rule(f"{f.name} is one of {', '.join(f.values)}", "check", f"{f.name} IN ({listed})"))
            if f.least is not None:
                out.append(Rule(f"{f.name} is at least {f.least}", "check", f"{f.name} >= {f.least}"))
            if f.most is not None:
                out.append(Rule(f"{f.name} is at most {f.most}", "check", f"{f.name} <= {f.most}"))
            if f.positive:
                out.append(Rule(f"{f.name} is positive", "check", f"{f.name} > 0"))
        out += [Rule(f"{a} and {b} are set together", "check", f"({a} IS NULL) = ({b} IS NULL)") for a, b in self.paired]
        out += [Rule(f"{a} is at most {b}", "check", f"{a} <= {b}") for a, b in self.ordered]
        return out

    def well(self) -> Column:
        """True where a row satisfies every rule."""
        return reduce(lambda x, y: x & y, [F.coalesce(r.holds, F.lit(True)) for r in self.rules()])

    def violations_sql(self, source: str) -> str:
        """Per constraint: constraint, kind, violations."""
        lines = [f"SELECT '{r.name}' AS \"constraint\", '{r.kind}' AS kind, count(*) FILTER (WHERE NOT ({r.sql})) AS violations FROM {source}" for r in self.rules()]
        cols = ", ".join(self.key)
        unset = " OR ".join(f"{k} IS NULL" for k in self.key)
        lines.append(
            f"SELECT 'key {cols}', 'primary_key', count(*) FILTER (WHERE {unset}) + count(*) - count(DISTINCT ({cols})) FROM {source}")
        return "\nUNION ALL\n".join(lines)


# The columns, domains and ranges of the surveyed tables.
READINGS_FEATURES = TableType(
    "readings_features",
    (
        Field("sensor_id", "string"),
        Field("reading_date", "date"),
        Field("location", "string"),
        Field("parameter", "string"),
        Field("value", "double"),
        Field("status", "string", values=("Good", "Bad")),
        Field("reading_no", "int", least=1),
        Field("prev_value", "double", nullable=True),
        Field("delta", "double", nullable=True),
        Field("rolling_avg_7d", "double"),
        Field("bad_so_far", "int", least=0, most="reading_no"),
        Field("z_score", "double", nullable=True),
    ),
    key=("sensor_id", "parameter", "reading_no"),
    paired=(("prev_value", "delta"),),
)

LOCATION_STATS = TableType(
    "location_stats",
    (
        Field("location", "string"),
        Field("parameter", "string"),
        Field("readings", "bigint", least=1),
        Field("sensors", "bigint"),
        Field("avg_value", "double", nullable=True),
        Field("stddev_value", "double", nullable=True),
        Field("median_value", "double", nullable=True),
        Field("p95_value", "double", nullable=True),
        Field("min_value", "double", nullable=True),
        Field("max_value", "double", nullable=True),
        Field("bad_pct", "double", nullable=True),
        Field("first_reading", "date", nullable=True),
        Field("last_reading", "date", nullable=True),
    ),
    key=("location", "parameter"),
    ordered=(("first_reading", "last_reading"),),
)

OHLCV = TableType(
    "ohlcv",
    (
        Field("date", "date"),
        Field("ticker", "string"),
        Field("open", "double", positive=True),
        Field("high", "double", positive=True),
        Field("low", "double", positive=True),
        Field("close", "double", positive=True),
        Field("volume", "bigint"),
        Field("dividends", "double"),
        Field("stock_splits", "double"),
    ),
    key=("date", "ticker"),
    ordered=(("open", "high"), ("close", "high"), ("low", "open"), ("low", "close")),
)
