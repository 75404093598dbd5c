"""Jobs as sub-commands: python -m quillmark.cli JOB --data FOLDER --out FOLDER. Each writes its result as Parquet, whole or not at all."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from quillmark.plans import QUERIES
from quillmark.runtime import clean
from quillmark.sources import articles

#: Job: (query, what it does).
JOBS = {
    "link-urls": ("jo06_variant_lookup", "registry row of every URL mention, by URL variants"),
    "relink-urls": ("jo07_relink", "registry rows for mentions that have none"),
    "refresh-contexts": ("pi02_refresh_context", "paragraphs of mentions, as a batch found them again"),
    "find-candidates": ("pi03_candidates", "addresses of a batch that the registry doesn't know"),
    "insert-urls": ("sk02_insert_absent", "mentions since a batch that weren't there before"),
    "upsert-scores": ("sk04_upsert", "scores with those of a batch in their place"),
    "score-urls": ("pi05_score", "annotated spans of every mention's page"),
    "associate-names": ("pi06_entities", "registry rows of names, known pairs marked"),
    "enrich-references": ("pi07_enrich", "publisher hits with what is known of their papers"),
    "unique-references": ("pi08_unique_flags", "publisher hits not known from mentions"),
    "combine-references": ("pi09_combined", "evidence of all sources with its confidence"),
    "duplicate-references": ("wi03_later_copies", "publisher hits stored again"),
    "delete-copies": ("sk05_delete_copies", "publisher hits without their later copies"),
    "known-pairs": ("jo03_known_pairs", "papers with the resources they mention"),
    "sync-registry": ("jo19_sync", "what makes the registry like its source"),
    "registry-merge": ("pi11_merge", "attributes of resources entered twice"),
    "registry-duplicates": ("ag01_duplicate_keys", "keys entered more than once"),
    "repoint": ("pi23_repoint", "mentions of removed registry rows, repointed"),
    "backfill-categories": ("pi22_backfill", "categories of resources by their key"),
    "cascade-delete": ("sk06_cascade", "query log without removed resources"),
    "rollback": ("sk08_rollback", "rows before a checkpoint"),
    "host-link-size": ("ag03_host_link_size", "mentions of each host"),
    "host-clusters": ("pi16_host_clusters", "hosts with their pages and resources"),
    "host-tree": ("sk11_host_tree", "hosts with their most frequent paths"),
    "host-frequencies": ("sk12_frequency_csv", "hosts by their mentions"),
    "host-kinds": ("pi17_host_kinds", "kinds of hosts"),
    "url-status": ("wi11_inferred", "liveness inferred from the first checked address"),
    "down-sites": ("pi12_down_sites", "sites that fail again and again"),
    "check-updates": ("pi13_update_check", "drift, change and stated year of every resource's pages"),
    "label-mentions": ("pi14_labels", "newest labels of papers for their mentions"),
    "propagate-annotations": ("pi18_propagate", "labels for mentions of one description"),
    "repair-papers": ("pi19_paper_repair", "titles and years of papers"),
    "look-up-pmids": ("sr05_keyed_lookup", "PubMed ids by DOI"),
    "content-snapshots": ("pi21_snapshots", "oldest and newest page of each resource"),
    "content-drift": ("mt01_drift", "change between the oldest and newest text of a resource"),
    "version-cosine": ("tx07_version_cosine", "cosine of these texts"),
    "acronyms": ("ac02_clusters", "acronyms with clustered expansions"),
    "acronym-statistics": ("ac03_statistics", "figures over the acronyms"),
    "classify": ("ml01_classifier", "quality of the text classifier on held-out rows"),
    "topics": ("ml02_topics", "topic words"),
    "topic-words": ("ml03_document_words", "topic words of each document"),
    "topic-lines": ("sk13_topic_lines", "training lines of the topic models"),
    "entity-corpus": ("sk15_entity_corpus", "training sentences of the entity recogniser"),
    "job-log": ("sk14_job_log", "one row for each finished batch"),
}


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quillmark", description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)
    for job, (query, what) in JOBS.items():
        s = sub.add_parser(job, help=what)
        s.add_argument("--data", required=True, help="folder of the tables")
        s.add_argument("--out", required=True, help="folder of the result")
        if "batch" in inspect.signature(QUERIES[query]).parameters:
            s.add_argument("-d", "--batch", help="batch to work on (yyyyMM)")
    s = sub.add_parser("extract-urls", help="URL mentions of the article files of a folder")
    s.add_argument("--articles", required=True)
    s.add_argument("--year", type=int)
    s.add_argument("--out", required=True)
    p.add_argument("--shared", help="folder that all executors share, for intermediate tables (spark.checkpoint.dir)")
    a = p.parse_args(args)

    builder = SparkSession.builder.appName(f"quillmark {a.job}")
    spark = (builder.config("spark.checkpoint.dir", a.shared) if a.shared else builder).getOrCreate()
    if a.shared:
        spark.conf.set("spark.checkpoint.dir", a.shared)
    try:
        if a.job == "extract-urls":
            out = articles.url_mentions(articles.read_articles(spark, a.articles, a.year))
        else:
            batch = {"batch": a.batch} if getattr(a, "batch", None) else {}
            out = QUERIES[JOBS[a.job][0]](spark, a.data, **batch)
        out.write.mode("overwrite").parquet(a.out)
    finally:
        clean(spark)


if __name__ == "__main__":
    main()
