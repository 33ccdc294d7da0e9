"""Bronze feeds with every column an entity reads; unnamed columns are null."""

from scenarios import at

from siltline.plans.derived import kind
from siltline.plans.spec import LINEAGE

TYPES = {"whole text": "string", "decimal text": "string"}


def main_schema(spec):
    casts = {getattr(c, "name", None): c.cast for c in spec.columns}
    types = []
    for name in spec.source_columns:
        to = "timestamp" if name == "_ingested_at" else kind(name, casts.get(name))
        if name in LINEAGE[1:]:
            to = "string"
        types.append(f"`{name}` {TYPES.get(to, to)}")
    return ", ".join(types)


def main_feed(spark, spec, rows):
    names = spec.source_columns
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], main_schema(spec))


def recon_feed(spark, spec, rows):
    keys = [k.name for k in spec.key_sources]
    schema = ", ".join(f"{k} bigint" for k in keys) + ", hard_delete boolean, dt_removed timestamp, ingested_at timestamp"
    names = [*keys, "hard_delete", "dt_removed", "ingested_at"]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def lineage(clock):
    return {"_ingested_at": at(clock), "_source_system": "sys", "_source_table": "tab"}
