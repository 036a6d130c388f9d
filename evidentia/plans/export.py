"""Evidence bundles: delivered packets bound to the chunks of their sources, checked, published whole."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions.text import namespaced, natural_key
from evidentia.operators import crosswalk as X
from evidentia.operators.validation import repeated, require_empty
from evidentia.schemas import PACKET, PACKET_FIELDS
from evidentia.sources import inputs, sinks
from evidentia.sources.shared import stored


POLICY = "paper_id_horizon"


def _placed(d: DataFrame, path: str) -> DataFrame:
    """horizon, group and stem from .../<horizon>/<group>/<stem>.<kind>."""
    parts = F.split(F.col(path), "/")
    return d.withColumns({"horizon": F.element_at(parts, -3), "group": F.element_at(parts, -2), "stem": F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")})


def read_packets(spark: SparkSession, wanted: str) -> DataFrame:
    """Packets of JSON files, each with its place and the digest of its bytes; a file that is no packet fails the read."""
    raw = spark.read.text(wanted, wholetext=True).select(F.col("value"), F.input_file_name().alias("packet_file"))
    p = raw.select(F.from_json("value", PACKET, {"mode": "FAILFAST"}).alias("p"), "packet_file", F.sha2("value", 256).alias("source_packet_sha256"))
    return _placed(p.select("p.*", "packet_file", "source_packet_sha256"), "packet_file")


def packet_violations(p: DataFrame, pdfs: DataFrame) -> DataFrame:
    """(rule, paper_id) of packets that can't be bound: odd file names, sources outside their group, missing ones, other bytes than the packet was made of, repeated ids."""
    inside = p.withColumns({"outside": F.col("source_file").rlike(r"(^/)|(^|/)\.\.(/|$)|://"), "named": F.col("stem") == F.col("original_id")})
    met = inside.join(pdfs.select(F.col("path_in_corpus"), F.col("source_sha256").alias("sha_now")), "path_in_corpus", "left")
    rule = (
        F.when(~F.coalesce("named", F.lit(False)), "name_differs").when(F.col("outside"), "source_escapes_group").when(F.col("sha_now").isNull(), "source_missing")
        .when(~F.coalesce(F.col("source_sha256") == F.col("sha_now"), F.lit(False)), "source_differs")
    )
    broken = met.withColumn("rule", rule).filter("rule is not null").select("rule", "paper_id")
    return broken.unionByName(repeated(p, ["paper_id"]).select(F.lit("id_repeats").alias("rule"), "paper_id"))


def export(spark: SparkSession, corpus: str, packets_root: str, target: str, horizon: str | None = None, group: str | None = None, paper: str | None = None) -> None:
    """Packets bound to the chunks of their PDFs: packets, chunks and crosswalks, a row each for a paper, and manifests with their digests.

    A packet names its source in its group (``metadata.source_file``, else its own name) and the digest of
    the source's bytes; any violation (see ``packet_violations``), provenance that meets no
    chunk, or no packet at all is a ValueError, and nothing is published.
    """
    wanted = f"{packets_root.rstrip('/')}/{horizon or '{long,short}'}/{group or '*'}/{paper or '*'}.json"
    try:
        p = read_packets(spark, wanted)
    except AnalysisException as e:
        raise ValueError(f"no packets at {wanted}") from e
    place = F.concat_ws("/", "horizon", "group")
    file = F.coalesce(F.try_element_at("metadata", F.lit("source_file")), F.concat("paper_id", F.lit(".pdf")))
    file = F.when(F.startswith(file, F.concat(place, F.lit("/"))), F.substring(file, F.length(place) + 2, F.lit(2**30))).otherwise(file)
    p = p.withColumns({"original_id": F.col("paper_id"), "source_file": file, "source_sha256": F.try_element_at("metadata", F.lit("source_sha256"))})
    p = p.withColumns({"paper_id": namespaced(F.col("paper_id"), F.col("horizon")), "path_in_corpus": F.concat_ws("/", place, "source_file")})
    more = {"ablation_original_paper_id": "original_id", "ablation_horizon": "horizon", "ablation_group": "group", "ablation_source_packet_sha256": "source_packet_sha256"}
    told = F.create_map(*(x for k, c in more.items() for x in (F.lit(k), F.col(c))), F.lit("ablation_namespace_policy"), F.lit(POLICY))
    kept = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*more, "ablation_namespace_policy"))
    p = stored(p.withColumn("metadata", F.map_concat(kept, told)), "packets")
    if not p.limit(1).count():
        raise ValueError(f"no packets at {wanted}")
    pdfs = stored(inputs.parsed(spark, corpus).withColumnsRenamed({"source_file": "path_in_corpus", "paper_id": "pdf_id"}), "pdfs")
    require_empty(packet_violations(p, pdfs), "packets can't be bound to their sources")
    both = p.select("paper_id", "original_id", "horizon", "group", "source_file", "path_in_corpus").join(pdfs.select("path_in_corpus", "source_sha256", "chunks"), "path_in_corpus")
    rows = both.select("paper_id", F.inline_outer("chunks")).filter("chunk_id is not null")
    public = p.select(*(f.name for f in p.schema.fields if f.name in PACKET_FIELDS))
    require_empty(X.problems(public, rows), "provenance or ledger differ from the chunks")
    walks = X.crosswalk(public, rows)
    documents = both.select("paper_id", "original_id", "horizon", "group", "source_file", "source_sha256", F.size("chunks").alias("chunk_count"), "chunks")
    as_text = lambda d, name: d.select("paper_id", F.to_json(F.struct(*d.columns)).alias(name), F.sha2(F.to_json(F.struct(*d.columns)), 256).alias(f"{name}_sha256"))
    sums = [stored(as_text(d, n), n) for d, n in ((sinks.delivered(public), "packet"), (documents, "chunk"), (walks, "crosswalk"))]
    record = p.select("paper_id", "original_id", "horizon", "group", "source_packet_sha256", "source_sha256", F.col("path_in_corpus").alias("source_pdf_path"))
    record = record.join(documents.select("paper_id", "chunk_count"), "paper_id").join(walks.select("paper_id", "reference_count", "minimum_similarity"), "paper_id", "left")
    for d, kind in zip(sums, ("packet", "chunk", "crosswalk"), strict=True):
        path = F.concat(F.lit(f"{kind}s/paper_id="), "paper_id")
        record = record.join(d.select("paper_id", F.when(F.col(f"{kind}_sha256").isNotNull(), path).alias(f"{kind}_path"), f"{kind}_sha256"), "paper_id", "left")
    record = stored(record.withColumn("order_key", natural_key(F.col("paper_id"))), "records")
    # a group's digest is its papers' digests added up; of the papers only ids are listed, their records are a table
    each = F.conv(F.substring(F.sha2(F.to_json(F.struct(*(c for c in record.columns if c != "order_key"))), 256), 1, 15), 16, 10).cast("decimal(20,0)")
    manifest = record.groupBy("horizon", "group").agg(
        F.count("*").alias("paper_count"), F.sum("chunk_count").alias("chunk_count"), F.min("minimum_similarity").alias("minimum_similarity"), F.sha2(F.sum(each).cast("string"), 256).alias("content_sha256"), 
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("order_key").alias("k"), F.col("paper_id").alias("i")))), lambda x: F.struct(x["i"].alias("paper_id"))).alias("papers"),
    )
    sinks.write_bundle(dict(zip(("packets", "chunks", "crosswalks"), (d.select("paper_id", F.col(n).alias("value")) for d, n in zip(sums, ("packet", "chunk", "crosswalk"), strict=True)), strict=True)), record, manifest, target)
