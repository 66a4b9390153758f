"""Command line: the same jobs by name over a folder of Parquet tables (one per relation)."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leafmill.functions import language_profiles, rules, text
from leafmill.operators import backfill, browse, control, embedding_dedupe, export, hash_dedupe, statistics, views
from leafmill.plans import execution, stages, steps
from leafmill.plans.steps import load, table
from leafmill.sources import archives, schemas, shards, sinks
from leafmill.sources.snapshots import put_if_absent, read_text
from leafmill.sources.staging import drop_staged, staged

COMMANDS: dict[str, tuple[Callable, Callable | None]] = {}


def session(name: str = "leafmill") -> SparkSession:
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    return spark


def command(name: str, options: Callable | None = None):
    def register(f):
        COMMANDS[name] = (f, options)
        return f

    return register


@command("build", lambda p: p.add_argument("source"))
def build(spark, a):
    """Upsert volumes from a Parquet snapshot of barcode and metadata."""
    for name in schemas.TABLES:
        table(spark, a.root, name).create()
    fresh = sinks.add_columns(spark.read.parquet(a.source), {"metadata": "string", "pull_date": "timestamp"}).select("barcode", "metadata", "pull_date")
    table(spark, a.root, "volume").change(lambda old: control.index_volumes(old, fresh))


@command("vacuum", lambda p: p.add_argument("--keep", type=int, default=2))
def vacuum(spark, a):
    """Remove versions of the relations that are neither recent nor current."""
    for name in schemas.TABLES:
        table(spark, a.root, name).vacuum(a.keep)


@command("clear-cache")
def clear_cache(spark, a):
    spark.catalog.clearCache()
    drop_staged(spark)


@command("system-status")
def system_status(spark, a):
    statistics.table_counts(load(spark, a.root)).show(100, False)


def _prepare(p):
    p.add_argument("--run", type=int, required=True)
    p.add_argument("--offset", type=int, default=0)
    p.add_argument("--limit", type=int)
    p.add_argument("--items-per-batch", type=int, default=1000)
    p.add_argument("--append-mode", action="store_true")


@command("prepare", _prepare)
def prepare(spark, a):
    """Make a run: its batches and items."""
    t = load(spark, a.root, "volume", "pipeline_batch", "pipeline_batch_item", "pipeline_run")
    batches, items = control.prepare_run(t["volume"], a.run, a.items_per_batch, a.offset, a.limit, t["pipeline_batch_item"] if a.append_mode else None)
    top = t["pipeline_batch"].agg(F.coalesce(F.max("id_pipeline_batch"), F.lit(0))).first()[0], t["pipeline_batch_item"].agg(F.coalesce(F.max("id_pipeline_batch_item"), F.lit(0))).first()[0]
    items = items.select((F.col("id_pipeline_batch_item") + top[1]).alias("id_pipeline_batch_item"), (F.col("id_pipeline_batch") + top[0]).alias("id_pipeline_batch"), "barcode")
    rows = items.groupBy("id_pipeline_batch").count().select("id_pipeline_batch", F.lit(a.run).cast("long").alias("id_pipeline_run"), F.current_timestamp().alias("created_date"), F.lit(False).alias("has_crashed"))
    total = items.count()
    rows = sinks.add_columns(rows, {"node_name": "string", "started_date": "timestamp", "ended_date": "timestamp"}).select(*t["pipeline_batch"].columns)
    table(spark, a.root, "pipeline_batch").change(lambda _: rows, append=True)
    table(spark, a.root, "pipeline_batch_item").change(lambda _: items, append=True)
    made = spark.createDataFrame([(a.run, total, a.items_per_batch, -(-total // a.items_per_batch))], "id_pipeline_run bigint, items_total int, items_per_batch int, batches_total int").withColumn("created_date", F.current_timestamp())
    table(spark, a.root, "pipeline_run").change(lambda _: made, append=True)


@command("run-status", lambda p: p.add_argument("--run", type=int))
def run_status(spark, a):
    b = load(spark, a.root, "pipeline_batch")["pipeline_batch"]
    control.status(b if a.run is None else b.where(F.col("id_pipeline_run") == a.run)).orderBy("id_pipeline_batch").show(1000, False)


def _hash(p):
    p.add_argument("--run", type=int)
    p.add_argument("--hamming-threshold", type=int, default=hash_dedupe.THRESHOLD)
    p.add_argument("--max-bucket", type=int, help="leave out buckets of more different hashes; by default none is")


@command("dedupe-hash", _hash)
def dedupe_hash(spark, a):
    t = load(spark, a.root, "image_hash", "pipeline_batch", "pipeline_batch_item")
    fresh = staged(hash_dedupe.dedupe_by_hash(t["image_hash"], t["pipeline_batch"], t["pipeline_batch_item"], a.run, threshold=a.hamming_threshold, max_bucket=a.max_bucket).withColumn("created", F.current_timestamp()), "deduped")
    table(spark, a.root, "deduped_hash").change(lambda old: sinks.replaced(old, fresh))


def _embedding(p):
    p.add_argument("--run", type=int)
    p.add_argument("--threshold", type=float, default=embedding_dedupe.DISTANCE)
    p.add_argument("--max-neighbors", type=int, default=embedding_dedupe.NEIGHBOURS)
    p.add_argument("--exact", action="store_true")


@command("dedupe-embedding", _embedding)
def dedupe_embedding(spark, a):
    t = load(spark, a.root, "image_embedding", "pipeline_batch", "pipeline_batch_item")
    fresh = staged(embedding_dedupe.dedupe_by_embedding(t["image_embedding"], a.threshold, a.max_neighbors, a.exact, t["pipeline_batch"], t["pipeline_batch_item"], a.run).withColumn("created", F.current_timestamp()), "deduped")
    table(spark, a.root, "deduped_embedding").change(lambda old: sinks.replaced(old, fresh))


@command("create-view", lambda p: (p.add_argument("--out", required=True), p.add_argument("--drop-existing", action="store_true")))
def create_view(spark, a):
    """The filtered dataset as a table; one that is there stays, unless it is to be dropped."""
    views.filtered_dataset(load(spark, a.root)).write.mode("overwrite" if a.drop_existing else "error").parquet(a.out)


@command("train-languages", lambda p: (p.add_argument("source", help="Parquet table of text and lang"), p.add_argument("--profiles", required=True)))
def train_languages(spark, a):
    """Learn trigram profiles from texts of known language."""
    put_if_absent(spark, a.profiles, language_profiles.saved(language_profiles.train(spark.read.parquet(a.source))))


def _backfill(p):
    p.add_argument("--profiles", help="file of language profiles; without it function words decide")
    p.add_argument("--thesaurus")
    p.add_argument("--skip-thesaurus", action="store_true")
    p.add_argument("--force", action="store_true")
    p.add_argument("--limit", type=int)


@command("backfill", _backfill)
def run_backfill(spark, a):
    detect = language_profiles.detector(language_profiles.loaded(read_text(spark, a.profiles)), rules.codes()) if a.profiles else None
    thesaurus = spark.read.parquet(a.thesaurus) if a.thesaurus and not a.skip_thesaurus else None
    table(spark, a.root, "caption").change(lambda c: backfill.backfill(c, thesaurus, detect, a.force, a.limit))


def _out(p):
    p.add_argument("--out", required=True)


@command("count-tokens", lambda p: (_out(p), p.add_argument("--vocabulary", help="a tokenizer's JSON file")))
def count_tokens(spark, a):
    v = views.filtered_dataset(load(spark, a.root))
    sinks.write_json(statistics.tokens(backfill.token_counts(v, "caption_text", vocabulary=a.vocabulary), "n_tokens"), a.out)


@command("stats", lambda p: (_out(p), p.add_argument("--skip-slow", action="store_true"), p.add_argument("--vocabulary", help="a tokenizer's JSON file, to count captions in tokens")))
def stats(spark, a):
    sinks.write_json(statistics.all_statistics(load(spark, a.root), a.skip_slow, a.vocabulary), a.out)


def _export(p):
    _out(p)
    p.add_argument("--kind", choices=["hub", "store"], default="hub")
    p.add_argument("--shard-size", type=int, default=shards.SHARD_ROWS)
    p.add_argument("--row-group-size", type=int, default=shards.GROUP_ROWS)
    p.add_argument("--classification-threshold", type=float, default=0.70)
    p.add_argument("--music-keywords", help="JSON file of language code to keywords")
    p.add_argument("--skip-music-reclassification", action="store_true")
    p.add_argument("--crops", help="folder of the archives of crops; elements without one become dead letters")
    p.add_argument("--chunk-index", type=int, default=0)
    p.add_argument("--total-chunks", type=int, default=1)
    p.add_argument("--prefix", default="shard", help="first part of a store's file names")
    p.add_argument("--sample", type=int, help="a seeded sample of so many items")
    p.add_argument("--limit", type=int, help="the first items only")
    p.add_argument("--dry-run", action="store_true")


@command("export", _export)
def run_export(spark, a):
    """Write the shards of records that aren't there yet, by split for a hub."""
    words = None
    if a.music_keywords and not a.skip_music_reclassification:
        import json

        words = json.loads("\n".join(r.value for r in spark.read.text(a.music_keywords).collect()))
    v = views.filtered_dataset(load(spark, a.root))
    items = v.select(F.col("pipeline_batch_item_id").alias("id")).distinct()
    if a.total_chunks > 1:
        items = control.chunk(items, a.chunk_index, a.total_chunks)
    if a.sample is not None:
        items = export.sample(items, a.sample, "id")
    if a.limit is not None:
        items = items.orderBy("id").limit(a.limit)
    v = v.join(items.withColumnRenamed("id", "pipeline_batch_item_id"), "pipeline_batch_item_id", "left_semi")
    crops = archives.crops(spark, a.crops, v).select("id_detection", "png") if a.crops else None
    r = export.records(v, a.kind, a.classification_threshold, words, crops=crops)
    if crops is not None:
        r = stages.turned(r)
        if not a.dry_run:
            sinks.write_dead_letters(export.missing_crops(v, crops), f"{a.out}_failed_crops")
    hub = a.kind == "hub"
    plan = shards.planned(r, a.shard_size, hub, None if hub else a.prefix, a.chunk_index if a.total_chunks > 1 else None)
    print(shards.write_shards(spark, plan, a.out, a.row_group_size, a.dry_run))


@command("atlas", lambda p: (_out(p), p.add_argument("--sample", type=int, default=10_000)))
def atlas(spark, a):
    export.atlas(views.filtered_dataset(load(spark, a.root)), a.sample).write.mode("overwrite").parquet(a.out)


def _viewer(p):
    _out(p)
    p.add_argument("--volume", nargs="*", help="some volumes only")
    p.add_argument("--classes", nargs="*", help="elements of some classes only")
    p.add_argument("--detections-only", action="store_true", help="rows of elements in place of a document a volume")


@command("viewer", _viewer)
def viewer(spark, a):
    v = views.filtered_dataset(load(spark, a.root))
    v = v if a.volume is None else v.where(F.col("barcode").isin(*a.volume))
    v = v if a.classes is None else v.where(F.col("pred_class").isin(*a.classes))
    documents = export.viewer_documents(v)
    sinks.write_json(export.viewer_rows(documents) if a.detections_only else documents, a.out)
    sinks.write_json(export.viewer_index(v), f"{a.out}_index")


@command("read-viewer", lambda p: (p.add_argument("source"), p.add_argument("--volume", nargs="*")))
def read_viewer(spark, a):
    """Pages and elements of viewer documents that were written."""
    documents = spark.read.schema("barcode string, json string").json(a.source)
    export.viewer_rows(documents, a.volume).orderBy("barcode", "page", "id_detection").show(1000, 60)


def _peek(p):
    p.add_argument("--n", default="10")
    p.add_argument("--scope", choices=["elements", "volumes"], default="elements")
    p.add_argument("--sample-type", choices=["random", "first", "failed"], default="random")
    p.add_argument("--seed", type=int, default=42)


@command("peek", _peek)
def peek(spark, a):
    """Elements, or volumes with their header, and failure counts: a seeded sample, the first, or those whose caption failed."""
    t = load(spark, a.root)
    v = views.filtered_dataset(t)
    if a.sample_type == "failed":
        v = v.where(~F.col("pred_class").isin(*rules.UNCAPTIONED_CLASSES) & text.blank(F.col("caption_text")))
    key = "id_detection" if a.scope == "elements" else "barcode"
    ids = v.select(key).distinct()
    some = ids.orderBy(key).limit(int(a.n)) if a.sample_type == "first" and a.n != "all" else export.sample(ids, a.n, key, a.seed)
    v = v.join(some, key, "left_semi")
    (export.page_details(v) if a.scope == "elements" else browse.header(v, t["volume"])).show(1000, False)
    statistics.failures(t["detection"], t["classification"], t["caption"]).show()


#: Steps of a batch in order, with the option that names their model.
BATCH_STEPS: dict[str, tuple[Callable, str]] = {
    "step01-detect": (steps.detect, "detector"), "step02-classify": (steps.classify, "classifier"), "step03-generate-dedupe-data": (steps.embed, "embedder"), "step04-caption": (steps.caption, "captioner"),
}


def _model(p, name: str, required: bool = True):
    p.add_argument(f"--{name}", required=required, help="module:function that makes the model")


def _step(name: str, f: Callable, model: str) -> None:
    def options(p):
        p.add_argument("--batch", type=int, required=True)
        p.add_argument("--archives", required=True, help="folder of the volumes' archives")
        _model(p, model)

    def run(spark, a):
        f(spark, a.root, a.batch, a.archives, steps.loader(getattr(a, model)))

    run.__doc__ = f.__doc__
    command(name, options)(run)


for _name, (_f, _of) in BATCH_STEPS.items():
    _step(_name, _f, _of)


@command("step05-store", lambda p: (p.add_argument("--batch", type=int, required=True), p.add_argument("--archives", required=True), _out(p)))
def store(spark, a):
    steps.store(spark, a.root, a.batch, a.archives, a.out)


def _orientation(p):
    p.add_argument("--archives", required=True)
    p.add_argument("--force", action="store_true")
    p.add_argument("--limit", type=int)
    _model(p, "orienter")


@command("orientation-correction", _orientation)
def orientation(spark, a):
    steps.orient(spark, a.root, a.archives, steps.loader(a.orienter), a.force, a.limit)


def _execute(p):
    p.add_argument("--run", type=int, required=True)
    p.add_argument("--force-batch", type=int)
    p.add_argument("--batch-only", action="store_true")
    p.add_argument("--ignore-locks", action="store_true")
    p.add_argument("--timeout", type=int, default=86_400)
    p.add_argument("--node", default="")
    p.add_argument("--archives", help="folder of the volumes' archives")
    p.add_argument("--crops", help="folder for the archives of crops")
    for _, of in BATCH_STEPS.values():
        _model(p, of, required=False)


@command("execute", _execute)
def run_execute(spark, a):
    """Claim the run's batches one by one, run the steps whose model is named, release, and stop at the first crash."""
    named = {name: (f, getattr(a, of)) for name, (f, of) in BATCH_STEPS.items() if getattr(a, of)}
    own = {name: (lambda batch, f=f, model=model: f(spark, a.root, batch, a.archives, steps.loader(model))) for name, (f, model) in named.items()}
    if a.crops:
        own["step05-store"] = lambda batch: steps.store(spark, a.root, batch, a.archives, a.crops)
    if own and not a.archives:
        raise SystemExit("--archives is missing")
    whole = {"dedupe-hash": lambda run: dedupe_hash(spark, argparse.Namespace(root=a.root, run=run, hamming_threshold=hash_dedupe.THRESHOLD, max_bucket=None))}
    batches = [r[0] for r in browse.run_batches(load(spark, a.root, "pipeline_batch")["pipeline_batch"], a.run).select("id_pipeline_batch").collect()]
    if not execution.execute(batches, steps.leases(spark, a.root, a.timeout), a.run, own, whole, a.node, a.force_batch, a.batch_only, a.ignore_locks):
        raise SystemExit(1)


def _run_all(p):
    _out(p)
    _backfill(p)
    p.add_argument("--skip-tokens", action="store_true")
    p.add_argument("--skip-atlas", action="store_true")
    p.add_argument("--sample", type=int, default=10_000)
    p.add_argument("--vocabulary")


@command("run-all", _run_all)
def run_run_all(spark, a):
    """View, backfill, token counts and atlas, up to the first that fails."""
    at = lambda name: argparse.Namespace(**(vars(a) | {"out": f"{a.out}/{name}", "drop_existing": True}))
    steps = {"create-view": lambda: create_view(spark, at("view")), "backfill": lambda: run_backfill(spark, a)}
    steps |= {} if a.skip_tokens else {"count-tokens": lambda: count_tokens(spark, at("tokens"))}
    steps |= {} if a.skip_atlas else {"atlas": lambda: atlas(spark, at("atlas"))}
    if not execution.run_all(steps):
        raise SystemExit(1)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="leafmill", description=__doc__)
    p.add_argument("root", help="folder of the relations")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        s = sub.add_parser(name, help=(f.__doc__ or "").strip() or None)
        if options:
            options(s)
    a = p.parse_args(argv)
    COMMANDS[a.command][0](session(), a)


if __name__ == "__main__":
    main()
