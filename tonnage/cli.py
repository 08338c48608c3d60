"""Command line over snapshots, datasets, the schema and the vocabulary.  Exit codes: 0 sound, 1 problems, 2 wrong use."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import functions as F

from tonnage.functions import ids
from tonnage.functions.versions import CURRENT
from tonnage.operators import exercises, integrity, labels, records, validation
from tonnage.plans import audit, corpus, history
from tonnage.plans.schema import FOREIGN_KEYS, TABLES, VOCABULARIES, TableSpec
from tonnage.session import session
from tonnage.sources import competition_csv as source


def history_spec(derived) -> dict[str, TableSpec]:
    fields = tuple((f.name, f.dataType.simpleString()) for f in derived.schema)
    return {"athlete_history": TableSpec("athlete_history", "derived", ("athlete_id",), ("athlete_id",), fields)}


def build(folder: str, out: str, ingested_at: datetime | None = None, shares: int = 16) -> integrity.Manifest:
    """Pinned snapshot to a corpus with its ``source`` row, histories in a derived dataset beside it."""
    spark = session()
    pinned = source.pinned(folder)
    path = source.snapshot_csv(folder)
    source.require_header(source.read_header(path))
    at = corpus.Build(pinned.source_id, ingested_at or datetime.now(timezone.utc))
    raw = source.read_csv(spark, f"file://{path.absolute()}")
    staging = integrity.located(out, "staging")
    if "://" not in str(out) and (Path(out) / "staging").exists() and not (Path(out) / "staging").is_dir():
        raise ValueError(f"{out}/staging is there and is no folder")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")  # one for each share: rows need not be sorted by it
    # written once by leading digest digit: six tables read it, each its own columns
    corpus.staged(raw, at).withColumn("p", ids.share(F.col("athlete_id"), shares)).write.mode("overwrite").partitionBy("p").option("compression", "zstd").parquet(staging)
    rows = spark.read.option("partitionColumnTypeInference", False).parquet(staging).drop("p")
    tables = {"source": corpus.sources(at, spark, display_name=pinned.archive_name, snapshot_sha256=pinned.archive_sha256)} | corpus.build_tables(rows, at)
    counted = corpus.counters(raw).first().asDict()
    manifest = integrity.write_dataset(tables, out, f"corpus-{pinned.archive_sha256[:16]}", sources=[{"source_id": pinned.source_id, "sha256": pinned.archive_sha256}], lineage=[{"step": "build", "counters": counted, "unrecognised": [r.asDict() for r in corpus.unrecognised(raw).orderBy("n", "column", "value", ascending=[False, True, True]).limit(1000).collect()]}])
    derived = history.athlete_histories(integrity.read_dataset(spark, out))
    integrity.write_dataset({"athlete_history": derived}, integrity.located(out, "derived"), "athlete-history", parent_digest=manifest.digest(), specs=history_spec(derived))
    return manifest


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tonnage", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)

    def verb(name: str, *names: str):
        p = verbs.add_parser(name)
        for n in names:
            p.add_argument(n)
        return p

    verb("acquire", "file", "root")
    verb("header", "file")
    verb("build", "snapshot", "out")
    verb("audit", "dataset", "out").add_argument("--snapshot-date")
    verb("validate", "dataset").add_argument("--strict", action="store_true")
    verb("verify", "dataset").add_argument("--snapshot", help="folder of the pinned snapshot, to check the source as well")
    verb("manifest", "dataset")
    verb("tables")
    verb("vocabularies")
    verb("show", "table")
    verb("inspect", "dataset", "table").add_argument("--limit", type=int, default=20)
    verb("timeline", "dataset", "athlete_id")
    resolving = verb("resolve", "label")
    resolving.add_argument("--source-system", default="generic_csv")
    resolving.add_argument("--vocabulary", help="JSON with definitions, aliases and refusals in place of the own vocabulary")
    verb("exercises").add_argument("--family")
    verb("canonical-build", "records", "out", "dataset_id").add_argument("--required", nargs="*", default=[])
    verb("ontology-build", "out").add_argument("--probe", nargs="*", default=[])
    verb("ontology-version")
    verb("schema-version")
    verb("schema-dump")
    verb("paths", "root")
    verb("inspect-tables", "dataset")
    verb("coverage", "labels")
    try:
        a = parser.parse_args(arguments)
    except SystemExit as e:
        return 2 if e.code else 0
    try:
        return _run(a)
    except (OSError, ValueError, KeyError) as e:
        print(e, file=sys.stderr)
        return 2


def _run(a: argparse.Namespace) -> int:
    show = lambda x: print(json.dumps(x, indent=2, ensure_ascii=False, default=str))
    if a.verb == "acquire":
        show(vars(source.acquire_local(a.file, a.root)))
    elif a.verb == "header":
        drift = source.review(source.read_header(a.file))
        show(vars(drift))
        return int(drift.any)
    elif a.verb == "build":
        show({n: x["rows"] for n, x in build(a.snapshot, a.out).artifacts.items()})
    elif a.verb == "tables":
        show({n: {"category": s.category, "primary_key": s.primary_key, "columns": len(s.columns)} for n, s in TABLES.items()})
    elif a.verb == "vocabularies":
        show(VOCABULARIES)
    elif a.verb == "show":
        s = TABLES[a.table]
        show({"primary_key": s.primary_key, "order": s.order, "columns": {f.name: f.dataType.simpleString() for f in s.schema}, "vocabularies": s.vocabularies})
    elif a.verb == "manifest":
        show(vars(integrity.read_manifest(session(), a.dataset)))
    elif a.verb == "verify":
        spark = session()
        problems = integrity.verify_dataset(spark, a.dataset)
        manifest = integrity.read_manifest(spark, a.dataset)
        if a.snapshot:
            problems += _source_problems(manifest, a.snapshot)
        if integrity.exists(spark, integrity.located(a.dataset, "derived", "manifest.json")):
            where = integrity.located(a.dataset, "derived")
            derived = history.athlete_histories(integrity.read_dataset(spark, a.dataset))
            if integrity.read_manifest(spark, where).parent_digest != manifest.digest():
                problems.append("derived: made from another dataset")
            problems += [f"derived: {x}" for x in integrity.verify_dataset(spark, where, specs=history_spec(derived))]
        broken = [r.asDict() for r in audit.invariants(_corpus(a.dataset)).where("observed <> expected").collect()]
        show({"problems": problems, "invariants": broken})
        return int(bool(problems or broken))
    elif a.verb == "audit":
        date = datetime.fromisoformat(a.snapshot_date).replace(tzinfo=timezone.utc) if a.snapshot_date else None
        manifest = integrity.read_manifest(session(), a.dataset)
        built = {"sources": manifest.sources, "steps": manifest.lineage, "environment": manifest.environment, "versions": manifest.versions}
        report = audit.audit(_corpus(a.dataset), source=built, snapshot=date)
        Path(f"{a.out}.json").write_bytes(audit.to_json(report))
        Path(f"{a.out}.md").write_text(audit.to_markdown(report))
    elif a.verb == "validate":
        found = validation.report(integrity.read_dataset(session(), a.dataset), strict=a.strict)
        show(found)
        return int(not found["sound"])
    elif a.verb == "inspect":
        integrity.in_order(integrity.read_dataset(session(), a.dataset)[a.table], TABLES[a.table].order).show(a.limit, truncate=False)
    elif a.verb == "timeline":
        validation.timeline(integrity.read_dataset(session(), a.dataset), a.athlete_id).show(1000, truncate=False)
    elif a.verb == "resolve":
        words = labels.Vocabulary.of(**json.loads(Path(a.vocabulary).read_text())) if a.vocabulary else exercises.vocabulary()
        one = session().createDataFrame([(a.label, a.source_system)], "raw_label string, source_system string")
        show(labels.resolve(one, words).first().asDict(recursive=True))
    elif a.verb == "exercises":
        chosen = [d for d in exercises.vocabulary().definitions if a.family in (None, d["parent_lift"])]
        show({d["key"]: {k: v for k, v in d.items() if k != "key"} for d in sorted(chosen, key=lambda d: d["key"])})
    elif a.verb == "canonical-build":
        tables = records.load(session(), a.records, tuple(a.required))
        show(integrity.write_dataset({n: df for n, df in tables.items() if not df.isEmpty()} or {"source": tables["source"]}, a.out, a.dataset_id).artifacts)
    elif a.verb == "ontology-build":
        tables = labels.artifact(session(), exercises.vocabulary(), a.probe)
        show(integrity.write_dataset(tables, a.out, f"ontology-{CURRENT['ontology'].rpartition('/')[2]}").artifacts)
    elif a.verb == "ontology-version":
        show({k: CURRENT[k] for k in ("ontology", "aliases")})
    elif a.verb == "schema-version":
        show({k: CURRENT[k] for k in ("schema", "manifest")})
    elif a.verb == "schema-dump":
        show({n: {"category": s.category, "primary_key": s.primary_key, "order": s.order, "columns": {f.name: f.dataType.simpleString() for f in s.schema}, "vocabularies": s.vocabularies, "foreign_keys": [k[1:] for k in FOREIGN_KEYS if k[0] == n]} for n, s in TABLES.items()})
    elif a.verb == "paths":
        show({k: str(source.resolve_within(a.root, v)) for k, v in source.LAYOUT.items()})
    elif a.verb == "inspect-tables":
        found = integrity.require_readable(session(), a.dataset)
        show({n: {"rows": x["rows"], "files": len(x["files"]), "content_digest": x["content_digest"]} for n, x in found.artifacts.items()})
    elif a.verb == "coverage":  # a CSV of raw_label, source_system
        given = session().read.csv(a.labels, header=True, schema="raw_label string, source_system string")
        show({r["resolution_status"]: r["n"] for r in labels.coverage(labels.resolve(given, exercises.vocabulary())).orderBy("resolution_status").collect()})
    return 0


def _source_problems(manifest: integrity.Manifest, folder: str) -> list[str]:
    """What the pinned snapshot below ``folder`` and the dataset's manifest say against each other."""
    try:
        path = source.snapshot_csv(folder)
        source.require_header(source.read_header(path))
    except (source.SourceError, OSError) as e:
        return [f"source: {e}"]
    pinned = source.pinned(folder)
    said = {x["source_id"]: x["sha256"] for x in manifest.sources}
    problems = [] if said.get(pinned.source_id) == pinned.archive_sha256 else [f"source: the dataset was not built from {pinned.source_id}"]
    rows = [x["counters"]["source_rows"] for x in manifest.lineage if "counters" in x]
    return problems + [f"source: {pinned.rows} rows, {n} were read" for n in rows if n != pinned.rows]


def _corpus(folder: str) -> dict:
    names = ("athlete", "athlete_source_link", "competition_meet", "competition", "competition_attempt", "competition_reported_result")
    tables = integrity.read_dataset(session(), folder)
    return {n: tables[n] for n in names}


if __name__ == "__main__":
    sys.exit(main())
