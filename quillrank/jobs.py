"""The two dataflows as batch jobs, from input paths to ``name<TAB>value`` lines.

    spark-submit --py-files quillrank.zip quillrank/jobs.py tfidf --articles IN --term cloud --out OUT
    spark-submit ... quillrank/jobs.py index --articles IN --out TABLE
    spark-submit ... quillrank/jobs.py tfidf --index TABLE --term cloud --out OUT
    spark-submit ... quillrank/jobs.py pagerank --variant B --arcs IN --labels IN --out OUT --state STATE

``python -m quillrank.jobs`` takes the same arguments. Paths are any Hadoop
URIs. The output is one folder of text; ``--k 0`` writes the full result, in
parallel and unordered, or with ``--ordered`` as parts that are in total order
by name, instead of the k best in order. ``index`` writes a keyed table of all
weights, from which ``tfidf --index`` takes any number of terms without
reading the articles again. ``--state`` names a folder from which a PageRank
run that was lost goes on. ``--mode QUARANTINE --bad DIR`` keeps malformed
records in subfolders of DIR and prints how many there were.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from quillrank.operators.keyed import WeightTable
from quillrank.operators.pagerank import DISTINCT_CONTRIBS, DISTINCT_LABELS, pagerank, rank_labels
from quillrank.operators.tfidf import BEFORE_COMMA, FULL, tfidf_term, tfidf_topk
from quillrank.operators.topk import UTF8, UTF16, bottom_k, top_k
from quillrank.session import ensure_checkpoint_dir
from quillrank.sinks import write_lines, write_sorted_lines
from quillrank.sources import read_arcs, read_articles, read_labels
from quillrank.sources.text import ARCS, ARTICLES, DROPMALFORMED, FAILFAST, LABELS, QUARANTINE, quarantine

#: Per variant: field delimiter, whether dangling mass is shared, and what divides it.
VARIANTS = {"A": ("ws", True, DISTINCT_CONTRIBS), "B": ("tab", True, DISTINCT_LABELS), "C": ("tab", False, DISTINCT_LABELS)}


def _read(spark: SparkSession, kind: str, path: str, delimiter: str, mode: str, bad: str | None) -> DataFrame:
    """The records of one input; with QUARANTINE, ``bad`` gets a folder for each kind."""
    if mode.upper() == QUARANTINE:
        if not bad:
            raise ValueError("QUARANTINE needs a folder for malformed records")
        halves = quarantine(spark.read.text(path), kind, f"{bad.rstrip('/')}/{kind}", delimiter, mode="overwrite")
        print(f"{kind}: {halves.counts['good']} records, {halves.counts['bad']} malformed")
        return halves.good
    if kind == ARTICLES:
        return read_articles(spark, path, mode=mode)
    return (read_arcs if kind == ARCS else read_labels)(spark, path, delimiter, mode=mode)


def run_index(spark: SparkSession, articles: str, out: str, buckets: int | None = None, mode: str = FAILFAST, bad: str | None = None) -> None:
    """The keyed table of all weights."""
    WeightTable.build(_read(spark, ARTICLES, articles, "tab", mode, bad), out, buckets)


def run_tfidf(spark: SparkSession, articles: str | None, out: str, term: str = "cloud", k: int = 100,
              title_key: str = FULL, mode: str = FAILFAST, index: str | None = None, ordered: bool = False, bad: str | None = None) -> None:
    """Weights of one term by title, from articles or from an index: the k best, or all for k = 0."""
    if (articles is None) == (index is None):
        raise ValueError("give articles or an index")
    if index:
        table = WeightTable.open(spark, index)
        best, every = table.topk(term, k or 1, title_key=title_key), table.lookup(term, title_key=title_key)
    else:
        arts = _read(spark, ARTICLES, articles, "tab", mode, bad)
        best, every = tfidf_topk(arts, term, k or 1, title_key=title_key), tfidf_term(arts, term, title_key=title_key)
    if k:
        write_lines(best, out, ["title", "w"], single_file=True)
    elif ordered:
        write_sorted_lines(every, out, ["title", "w"], "w", "title")
    else:
        write_lines(every, out, ["title", "w"])


def run_pagerank(spark: SparkSession, arcs: str, labels: str, out: str, variant: str = "B", iterations: int = 10,
                 k: int = 100, delimiter: str | None = None, mode: str = FAILFAST, bottom: bool = False,
                 state: str | None = None, ordered: bool = False, order: str = UTF8, bad: str | None = None) -> None:
    """Ranks by label: the k best (or worst), or all for k = 0."""
    ensure_checkpoint_dir(spark)
    own, dangling, normalizer = VARIANTS[variant]
    names = _read(spark, LABELS, labels, delimiter or own, mode, bad)
    links = _read(spark, ARCS, arcs, delimiter or own, mode, bad)
    ranks = pagerank(links, names, iterations=iterations, dangling=dangling, normalizer=normalizer, state=state)
    ranked = rank_labels(ranks, names)
    if k:
        write_lines((bottom_k if bottom else top_k)(ranked, "rank", "name", "id", k=k, order=order), out, ["name", "rank"], single_file=True)
    elif ordered:
        write_sorted_lines(ranked, out, ["name", "rank"], "rank", "name", "id", ascending=bottom, order=order)
    else:
        write_lines(ranked, out, ["name", "rank"])


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quillrank.jobs", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)
    t, x, r = sub.add_parser("tfidf"), sub.add_parser("index"), sub.add_parser("pagerank")
    for q in (t, x, r):
        q.add_argument("--out", required=True)
        q.add_argument("--mode", choices=[FAILFAST, DROPMALFORMED, QUARANTINE], default=FAILFAST)
        q.add_argument("--bad")
    for q in (t, r):
        q.add_argument("--k", type=int, default=100)
        q.add_argument("--ordered", action="store_true")
    t.add_argument("--articles")
    t.add_argument("--index")
    t.add_argument("--term", default="cloud")
    t.add_argument("--title-key", choices=[FULL, BEFORE_COMMA], default=FULL)
    x.add_argument("--articles", required=True)
    x.add_argument("--buckets", type=int)
    r.add_argument("--arcs", required=True)
    r.add_argument("--labels", required=True)
    r.add_argument("--variant", choices=sorted(VARIANTS), default="B")
    r.add_argument("--iterations", type=int, default=10)
    r.add_argument("--delimiter", choices=["tab", "ws"])
    r.add_argument("--bottom", action="store_true")
    r.add_argument("--state")
    r.add_argument("--order", choices=[UTF8, UTF16], default=UTF8)
    a = vars(p.parse_args(args))
    job = {"tfidf": run_tfidf, "index": run_index, "pagerank": run_pagerank}[a.pop("job")]
    job(SparkSession.builder.appName("quillrank").getOrCreate(), **a)


if __name__ == "__main__":
    main()
