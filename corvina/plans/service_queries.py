"""Queries of sources and sinks with a protocol of their own: search streams, bundles, graph stores."""

from __future__ import annotations

import random
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models, ordering, scoring
from ..sources import bundles, fetching, files, graph_store, searching
from ..storage import shared_folder, tasks_for
from .registry import query, table


@query("SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events")
def s10_search_stream(spark: SparkSession, d: str) -> DataFrame:
    """All events by a search service's stream, in two runs of which the second goes on where the first ended."""
    at = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    days = events.groupBy("day").count().orderBy("day").collect()  # a row a day
    events.select("*", F.col("day").alias("_d")).withColumnRenamed("_d", "told").repartition("day").write.partitionBy("day").parquet(f"{at}/service")
    source = searching.search_stream("event_search", searching.DayFolder(f"{at}/service", "event_id"), page=2000, chunk=1000, cap=5000)
    spark.dataSource.register(source)
    for last in (days[len(days) // 2].day, None):
        options = {"first": days[0].day, "rate": "5000"} | ({"last": last} if last else {})
        stream = spark.readStream.format("event_search").schema("event_id bigint, user_id bigint, event_type string, value double, told string").options(**options).load()
        sink = stream.withColumnRenamed("told", "day").writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint")
        sink.trigger(availableNow=True).start(f"{at}/sink").awaitTermination()
    return spark.read.parquet(f"{at}/sink")


def _types_of_parts(spark: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit("part "), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select(
        F.lit("RadiomicFeature").alias("source_node_type"), part.alias("source_node"), F.lit("ImagingModality").alias("target_node_type"), F.col("p_type").alias("target_node"),
        F.lit("ACQUIRED_VIA").alias("rel_type"), F.lit("").alias("pmid"), F.lit("").alias("confidence"),
    ).distinct()


@query("""
WITH r AS (SELECT DISTINCT 'part ' || p_partkey AS a, p_type AS b FROM part)
SELECT 'nodes' AS part, (SELECT count(*) FROM (SELECT a FROM r UNION ALL SELECT DISTINCT b FROM r)) AS n UNION ALL SELECT 'relationships', count(*) FROM r
UNION ALL SELECT 'statements', 2 + (SELECT count(*) FROM (SELECT a FROM r UNION ALL SELECT DISTINCT b FROM r)) + count(*)
  FROM r UNION ALL SELECT 'records', count(*) FROM r UNION ALL SELECT 'post_total', count(*) FROM r""")
def s18_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Publishes a bundle in the shared folder, then tries one with a wrong total: what is read back is the first, as are its explorer records."""
    rels = _types_of_parts(spark, d)
    at = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    said = bundles.write_bundle(spark, rels, rels.limit(0), at, "2024-01-01T00:00:00Z")
    try:
        bundles.write_bundle(spark, rels.where("target_node_type = ''"), rels, at, "2024-01-02T00:00:00Z", expected={"relationships": said["counts"]["post_total"] + 1})
    except graph_store.Mismatch:
        pass
    else:
        raise AssertionError("a bundle with a wrong total was published")
    nodes, back, lines, manifest = bundle = bundles.read_bundle(spark, at)
    bundles.load_plan(bundle)
    bundles.write_explorer(spark, bundle, f"{at}/explorer")
    counts = {"nodes": nodes.count(), "relationships": back.count(), "statements": lines.count(), "records": bundles.read_explorer(spark, f"{at}/explorer").count(),
        "post_total": manifest["counts"]["post_total"]}
    return spark.createDataFrame(list(counts.items()), "part string, n bigint")


@query("SELECT DISTINCT 'part ' || p_partkey AS subject_node, p_type AS object_node, 'ACQUIRED_VIA' AS graph_rel_type FROM part")
def e13_explorer_export(spark: SparkSession, d: str) -> DataFrame:
    """Explorer records of a bundle, as they were published; an export of which a row is missing leaves them as they are."""
    rels = _types_of_parts(spark, d)
    at = f"{shared_folder(spark)}/explorer-{uuid.uuid4().hex}"
    bundles.write_bundle(spark, rels, rels.limit(0), f"{at}/bundle", "2024-01-01T00:00:00Z")
    nodes, back, lines, manifest = bundles.read_bundle(spark, f"{at}/bundle")
    bundles.write_explorer(spark, (nodes, back, lines, manifest), f"{at}/explorer")
    first = back.agg(F.min("source_node")).first()[0]
    try:
        bundles.write_explorer(spark, (nodes, back.where(F.col("source_node") != first), lines, manifest), f"{at}/explorer")
    except graph_store.Mismatch:
        pass
    else:
        raise AssertionError("an export that lacks a row was published")
    return bundles.read_explorer(spark, f"{at}/explorer").select("subject_node", "object_node", "graph_rel_type")


def _supplies(spark: SparkSession, d: str) -> DataFrame:
    """Which supplier has delivered which part by which return flag, with the largest discount."""
    name = lambda kind, c: F.concat(F.lit(kind + " "), F.col(c).cast("string"))
    keys = (name("supplier", "l_suppkey").alias("source_node"), name("part", "l_partkey").alias("target_node"), F.concat(F.lit("FLAG_"), "l_returnflag").alias("rel_type"))
    li = table(spark, d, "lineitem")
    by = ("l_suppkey", "l_partkey", "l_returnflag")
    rows = li.repartition(tasks_for(li), *by).groupBy(*by).agg(F.max("l_discount").alias("confidence")).select(*keys, "confidence")
    return rows.select(F.lit("Microbe").alias("source_node_type"), "source_node", F.lit("RadiomicFeature").alias("target_node_type"), "target_node", "rel_type", F.lit("").alias("pmid"), "confidence")


@query("""
WITH e AS (SELECT 'supplier ' || l_suppkey AS s, 'part ' || l_partkey AS p, 'FLAG_' || l_returnflag AS r, max(l_discount) AS confidence FROM lineitem GROUP BY ALL)
SELECT r AS kind, count(*) AS n, round(sum(CASE WHEN r = 'FLAG_R' THEN 1 ELSE confidence END), 4) AS confidence FROM e GROUP BY r
UNION ALL SELECT 'Microbe', count(DISTINCT s), NULL FROM e UNION ALL SELECT 'RadiomicFeature', count(DISTINCT p), NULL FROM e""")
def s19_graph_store(spark: SparkSession, d: str) -> DataFrame:
    """Edges of line items loaded into a store: a load that is repeated, one of changed rows, and one with a wrong count, which changes nothing."""
    at = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    edges = _supplies(spark, d)
    ends = F.inline(F.array(*[F.struct(F.col(f"{e}_node_type").alias("label"), F.col(f"{e}_node").alias("name")) for e in ("source", "target")]))
    for _ in range(2):
        graph_store.prepare(edges.select(ends).distinct(), at, "first", "nodes")
        graph_store.prepare(edges, at, "first", "relationships")
        graph_store.publish(at, "first")
    changed = edges.where("rel_type = 'FLAG_R'").withColumn("confidence", F.lit(1.0))
    graph_store.prepare(changed, at, "second", "relationships")
    graph_store.publish(at, "second", parts=("relationships",))
    try:
        graph_store.prepare(changed, at, "third", "relationships", expected=-1)
    except Exception as e:
        if "were expected" not in str(e):
            raise
    try:
        graph_store.publish(at, "third", parts=("relationships",))
    except graph_store.Mismatch:
        pass
    else:
        raise AssertionError("a load that wasn't prepared was published")
    rels = graph_store.read(spark, at, "relationships").groupBy(F.col("rel_type").alias("kind")).agg(F.count("*").alias("n"), F.round(F.sum("confidence"), 4).alias("confidence"))
    nodes = graph_store.read(spark, at, "nodes").groupBy(F.col("label").alias("kind")).agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("confidence"))
    return rels.unionByName(nodes)


def _length_of(url: str) -> bytes:
    """Stands in for a server: its answer to an address is how long that is; addresses of one host are not found."""
    if "example.org" in url:
        raise OSError("not found")
    return str(len(url)).encode()


@query("""
SELECT DISTINCT url, CASE WHEN contains(url, 'example.org') THEN NULL ELSE length(url)::VARCHAR END AS content,
       CASE WHEN contains(url, 'example.org') THEN 'OSError: not found' END AS reason FROM pages WHERE url IS NOT NULL""")
def s13_journaled_downloads(spark: SparkSession, d: str) -> DataFrame:
    """Every page's address through a stand-in for servers, by way of a journal; the second call finds all of them there."""
    journal = f"{shared_folder(spark)}/journal-{uuid.uuid4().hex}"
    pace = fetching.Pace(rate=10_000.0, burst=100, tries=1, groups=16)
    for _ in range(2):
        got = fetching.fetch_all(table(spark, d, "pages").select("url"), _length_of, journal, pace)
    return got.select("url", F.col("content").cast("string").alias("content"), "reason")


@dataclass(frozen=True)
class _Short:
    """A stand-in that takes short texts only, as models do."""

    most: int
    terms: models.Terms
    key: str = "short"

    def load(self) -> models.Model:
        answer = self.terms.load()

        def run(texts):
            if any(len(t) > self.most for t in texts):
                raise ValueError("too long")
            return answer(texts)

        return run


@query(r"""
SELECT conv_id, turn, CASE WHEN text IS NULL OR trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' OR length(text) > 1200 THEN NULL
  WHEN contains(text, '?') THEN 'question' WHEN contains(text, chr(10)) THEN 'lines' ELSE 'statement' END AS label,
  CASE WHEN text IS NULL THEN 'missing_text' WHEN trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 'empty_text'
       WHEN length(text) > 1200 THEN 'ValueError: too long' END AS reason FROM conversations""")
def v7_model_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of all turns by a stand-in for a model; turns that it can't take are rows with a reason."""
    terms = models.build("terms", labels=(("question", ("?",)), ("lines", ("\n",))), other="statement")
    told = models.label(table(spark, d, "conversations"), "text", _Short(1200, terms), asking=models.Asking(tries=2, wait=0.0))
    return told.select("conv_id", "turn", "label", F.col("label_reason").alias("reason"))


@query()
def w7_generator_sample(spark: SparkSession, d: str) -> DataFrame:
    """25 documents of each language, drawn by one generator from language to language, as from lists in the order of ids."""
    docs, rng, out = table(spark, d, "documents").select("doc_id", "lang"), random.Random(42), None
    for (lang,) in docs.select("lang").distinct().orderBy("lang").collect():  # a few
        some = scoring.generator_sample(docs.where(F.col("lang").eqNullSafe(lang)), 25, rng, "doc_id")
        out = some if out is None else out.unionByName(some)
    return out


@query("""
WITH n AS (SELECT count(*) AS n FROM events), p AS (SELECT DISTINCT CASE WHEN i = 299 THEN n - 1 ELSE floor(i * ((n - 1) / 299::DOUBLE))::BIGINT END AS pos FROM n, range(300) r(i)),
e AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events)
SELECT event_id FROM e JOIN p USING (pos)""")
def w6_evenly_spaced(spark: SparkSession, d: str) -> DataFrame:
    """300 events, evenly spaced in time."""
    return ordering.evenly_spaced(table(spark, d, "events").select("event_id", "ts"), 300, "ts", "event_id").select("event_id")


@query("""
SELECT 'events' AS stage, count(*) AS n, count(DISTINCT user_id) AS users, max(value) AS largest FROM events""")
def s5_run_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of a run, with the metrics that its job counted while it wrote."""
    at = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    rows, seen = files.with_metrics(table(spark, d, "events"), n=F.count("*"), largest=F.max("value"))
    rows.select("event_id", "user_id").write.parquet(f"{at}/out")
    metrics = seen.get | {"users": spark.read.parquet(f"{at}/out").select("user_id").distinct().count()}
    files.write_manifest(spark, f"{at}/manifest", "events", {"source": "events"}, metrics, {"rows": f"{at}/out"}, "2024-01-01T00:00:00Z")
    told = F.from_json("value", "stage string, metrics struct<n:bigint,users:bigint,largest:double>")
    return spark.read.text(f"{at}/manifest").select(told.alias("m")).select("m.stage", "m.metrics.n", "m.metrics.users", "m.metrics.largest")


def _bitmap(width: int, height: int, colour: tuple[int, int, int]) -> bytes:
    """A picture of one colour in the plainest of file formats: blue, green, red, lines padded to four bytes."""
    line = bytes(colour[::-1]) * width
    pixels = (line + bytes(-len(line) % 4)) * height
    head = struct.pack("<2sIHHI", b"BM", 54 + len(pixels), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(pixels), 2835, 2835, 0, 0) + pixels


@query("""
SELECT (1000000 + s_suppkey)::VARCHAR AS pmid, 'supplier_' || (1000000 + s_suppkey) AS caption, 3 + s_nationkey AS width, 2 + s_suppkey % 5 AS height,
       (s_suppkey % 256)::INT AS red, ((s_nationkey * 9) % 256)::INT AS blue FROM supplier""")
def s15_image_folder(spark: SparkSession, d: str) -> DataFrame:
    """Pictures that tasks write to a folder, one for each supplier, read back as the image source decodes them."""
    at = f"{shared_folder(spark)}/pictures-{uuid.uuid4().hex}"

    def run(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(at)
        for b in batches:
            for key, nation in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                folder = f"{root}/{key % 7}"
                fs.create_dir(folder, recursive=True)
                with fs.open_output_stream(f"{folder}/supplier_{1000000 + key}.bmp") as f:
                    f.write(_bitmap(3 + nation, 2 + key % 5, (key % 256, 40, nation * 9 % 256)))
            yield pa.RecordBatch.from_arrays([b.column(0)], ["key"])

    table(spark, d, "supplier").select("s_suppkey", "s_nationkey").mapInArrow(run, "key bigint").agg(F.count("*")).collect()  # a number
    byte = lambda i: F.conv(F.hex(F.substring("image.data", i, 1)), 16, 10).cast("int")
    found = files.images(spark, at)
    return found.select("pmid", "caption", F.col("image.width").alias("width"), F.col("image.height").alias("height"), byte(3).alias("red"), byte(1).alias("blue"))
