"""Descriptor and source registries, the catalogue, and column expressions kept as rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from configparser import ConfigParser
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators import fundamentals as fu, timeseries as ts

DescriptorFn = Callable[[DataFrame, Mapping], DataFrame]


@dataclass
class Registry:
    """Named functions DataFrame -> DataFrame with default parameters."""

    entries: dict[str, tuple[DescriptorFn, dict]] = field(default_factory=dict)

    def register(self, entry: str, fn: DescriptorFn, **params) -> None:
        """Add or replace a function under a name."""
        self.entries[entry] = (fn, params)

    def build(self, entry: str, df: DataFrame, **params) -> DataFrame:
        """Run one; call parameters override the registered ones."""
        fn, defaults = self.entries[entry]
        return fn(df, {**defaults, **params})


def choose(bulk: Sequence[DataFrame], keys: Sequence[str], value: str, logic: str = "first") -> DataFrame:
    """Business logic over several sources of one value: first, max, min or agree.

    ``agree`` keeps a value only where all sources that have one say the same.
    """
    from riskloom.operators.joins import priority

    if logic == "first":
        return priority(bulk, keys, value).drop("source")
    u = None
    for b in bulk:
        x = b.select(*keys, value)
        u = x if u is None else u.unionByName(x)
    g = u.groupBy(*keys)
    if logic == "agree":
        return g.agg(F.min(value).alias(value), F.max(value).alias("_m")).where(F.col(value) == F.col("_m")).drop("_m")
    return g.agg((F.max if logic == "max" else F.min)(value).alias(value))


def configured(text: str, sources: Registry, tables: Mapping[str, DataFrame], sections: Sequence[str] | None = None) -> DataFrame:
    """Values chosen as an INI text says, one section an item: section, keys, value.

    A section names its ``sources`` (comma-separated names of the registry, each with a table and parameters as
    ``name:table:key=value:...``), the ``keys`` and the ``value`` column, and the ``logic`` of ``choose``. A section
    without one of these, an unknown source, table or logic is an error; ``[DEFAULT]`` holds what all share.
    """
    parser = ConfigParser()
    parser.read_string(text)
    out = None
    for section in sections or parser.sections():
        if not parser.has_section(section):
            raise KeyError(f"no section {section}")
        s = parser[section]
        missing = [o for o in ("sources", "keys", "value", "logic") if not s.get(o)]
        if missing:
            raise KeyError(f"section {section} has no {', '.join(missing)}")
        if s["logic"] not in ("first", "max", "min", "agree"):
            raise KeyError(f"section {section}: unknown logic {s['logic']}")
        keys = [k.strip() for k in s["keys"].split(",")]
        bulk = []
        for entry in s["sources"].split(","):
            name, table, *params = entry.strip().split(":")
            if name not in sources.entries or table not in tables:
                raise KeyError(f"section {section}: unknown source {entry.strip()}")
            bulk.append(sources.build(name, tables[table], **dict(p.split("=", 1) for p in params)))
        x = choose(bulk, keys, s["value"], s["logic"]).select(F.lit(section).alias("section"), *keys, F.col(s["value"]).alias("value"))
        out = x if out is None else out.unionByName(x)
    if out is None:
        raise KeyError("no sections")
    return out


# Windows in steps of each return family; the catalogue is their product.
FAMILIES: dict[str, list[int]] = {"momentum": [1, 6, 12], "hist_vol": [6, 12, 24], "high_low": [6, 12], "turnover": [3, 12], "amihud": [12]}


def catalogue_rows() -> list[tuple[int, str, str, int, bool]]:
    """(id, name, family, window, is_local) for return families and ratios, made by rule."""
    rows = [(f"{fam}_{n}", fam, n, fam in {"high_low"}) for fam, ns in FAMILIES.items() for n in ns]
    for group, table in (("price", fu.PRICE_RATIOS), ("profit", fu.PROFIT_RATIOS), ("balance", fu.BALANCE_RATIOS), ("item", fu.ITEMS)):
        rows += [(name if group != "item" else f"item_{name}", group, 0, group == "item") for name in table]
    return [(i + 1, name, fam, n, local) for i, (name, fam, n, local) in enumerate(rows)]


def catalogue(spark: SparkSession) -> DataFrame:
    """The catalogue as a table."""
    return spark.createDataFrame(catalogue_rows(), "id int, name string, family string, window int, is_local boolean")


def returns_registry() -> Registry:
    """Registry holding every return descriptor of the catalogue."""
    reg = Registry()
    for fam, ns in FAMILIES.items():
        for n in ns:
            name = f"{fam}_{n}"
            build = {
                "momentum": lambda d, p: ts.momentum(d, "asset_id", "ret", p["n"], 0, "mi", name=p["name"]),
                "hist_vol": lambda d, p: ts.hist_vol(d, "asset_id", "ret", p["n"], "mi", p["name"]),
                "high_low": lambda d, p: ts.high_low(d, "asset_id", "mcap", p["n"], "mi").withColumnRenamed("high_low", p["name"]),
                "turnover": lambda d, p: ts.turnover(d, "asset_id", "volume", "mcap", p["n"], "mi").withColumnRenamed("turnover", p["name"]),
                "amihud": lambda d, p: ts.amihud(d, "asset_id", "ret", "volume", "mcap", p["n"], "mi").withColumnRenamed("amihud", p["name"]),
            }[fam]
            reg.register(name, build, n=n, name=name)
    return reg


def build_descriptors(panel: DataFrame, names: Sequence[str], registry: Registry | None = None, keys: Sequence[str] = ("asset_id", "dt")) -> DataFrame:
    """Several descriptors for all dates in one plan, as rows (keys, descriptor, value).

    They share the asset partitioning, so the panel is shuffled once.
    """
    reg = registry or returns_registry()
    out = panel
    for n in names:
        out = reg.build(n, out)
    return out.unpivot(list(keys), list(names), "descriptor", "value").where("value is not null")


# --- expressions as rows ------------------------------------------------------------------

UNARY: dict[str, Callable[[Column], Column]] = {
    "cos": F.cos, "sin": F.sin, "exp": F.exp, "uminus": lambda c: -c, "delta": lambda c: F.when(c == 0, 1.0).otherwise(0.0),
}
BINARY: dict[str, Callable[[Column, Column], Column]] = {
    "plus": lambda a, b: a + b, "minus": lambda a, b: a - b, "times": lambda a, b: a * b, "max": F.greatest, "min": F.least,
}


def expression(nodes: Mapping[int, tuple], root: int, variables: Mapping[str, Column]) -> Column:
    """Fold a tree kept as rows into one column.

    ``nodes``: id -> ("const", value), ("var", name), (unary, child) or (binary, left, right).
    """
    kind, *args = nodes[root]
    if kind == "const":
        return F.lit(float(args[0]))
    if kind == "var":
        return variables[args[0]]
    if kind in UNARY:
        return UNARY[kind](expression(nodes, args[0], variables))
    return BINARY[kind](expression(nodes, args[0], variables), expression(nodes, args[1], variables))


def expressions_from_table(rows: DataFrame) -> dict[int, tuple]:
    """Nodes of one expression from a table (id, kind, left, right, value, name); an expression has a handful of rows."""
    out = {}
    for r in rows.collect():
        if r.kind == "const":
            out[r.id] = ("const", r.value)
        elif r.kind == "var":
            out[r.id] = ("var", r.name)
        elif r.kind in UNARY:
            out[r.id] = (r.kind, r.left)
        else:
            out[r.id] = (r.kind, r.left, r.right)
    return out


def report(sections: Mapping[str, DataFrame]) -> DataFrame:
    """Report table: section, row text per column name, from several tables."""
    out = None
    for name, df in sections.items():
        key = df.columns[0]
        x = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        x = x.unpivot([key], df.columns[1:], "column", "text").select(F.lit(name).alias("section"), F.col(key).alias("row"), "column", "text")
        out = x if out is None else out.unionByName(x)
    return out
