"""One nested evidence row per review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quote
from ..session import join_per_group


def section(name: str, report: DataFrame, group_cols=(), order: str | None = None) -> DataFrame:
    """A report folded into one array of records per review. Reports hold rows per feature, bin or segment."""
    fields = [c for c in report.columns if c not in group_cols]
    first = [order] if order else []
    record = ", ".join(f"`{c}`" for c in [*first, *[f for f in fields if f not in first]])
    return report.groupBy(*group_cols).agg(F.expr(f"sort_array(collect_list(struct({record}))) AS `{name}`"))


def evidence_packet(reviews: DataFrame, sections: dict[str, DataFrame], group_cols=()) -> DataFrame:
    """`reviews` (one row per review) with every section joined as an array of records."""
    packet = reviews
    for name, report in sections.items():
        packet = join_per_group(packet, section(name, report, group_cols), group_cols)
    return packet


def flattened(packet: DataFrame, group_cols=()) -> DataFrame:
    """Every value of a packet as a row: review keys, section, position in it, path, text, and the number it is, if any.

    Plain columns are sections of one record at position 0, without a path. Nested records keep their JSON text. Nulls have
    no row.
    """
    keys = [f"`{g}`" for g in group_cols]
    kinds = {f.name: f.dataType for f in packet.schema.fields if f.name not in group_cols}
    parts = []
    plain = [c for c, t in kinds.items() if not isinstance(t, T.ArrayType)]
    if plain:
        cells = ", ".join(f"{quote(c)}, CAST(`{c}` AS STRING)" for c in plain)
        parts.append(packet.selectExpr(*keys, f"stack({len(plain)}, {cells}) AS (section, text)").selectExpr(
            *keys, "section", "0 AS position", "'' AS path", "text"
        ))
    for c, t in kinds.items():
        if isinstance(t, T.ArrayType):
            records = packet.selectExpr(*keys, f"posexplode(`{c}`) AS (position, record)")
            if isinstance(t.elementType, T.StructType):
                cells = records.selectExpr(*keys, "position", "explode(from_json(to_json(record), 'map<string,string>')) AS (path, text)")
            else:
                cells = records.selectExpr(*keys, "position", "'' AS path", "CAST(record AS STRING) AS text")
            parts.append(cells.selectExpr(*keys, f"{quote(c)} AS section", "position", "path", "text"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    return rows.where("text IS NOT NULL").withColumn("number", F.expr("try_cast(text AS DOUBLE)"))


def same_run(packet: DataFrame, visuals: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Visual records that belong to the run of the packet."""
    return visuals.join(packet.select(run_col).distinct(), run_col, "inner")
