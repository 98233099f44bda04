"""Command line: ``python -m quillmill <command> …``."""

from __future__ import annotations

import argparse

from quillmill.plans import articles, papers, posts, tweets
from quillmill.schemas import SOURCES
from quillmill.session import get_session
from quillmill.sources import readers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillmill", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, help: str, limited: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help)
        sub.add_argument("-o", "--output-dir", default=".")
        if limited:
            sub.add_argument("-l", "--limit", type=int, help="at most this many documents (default: all)")
        return sub

    ingest = command("ingest-articles", "index pages and article pages to new posts in the store")
    ingest.add_argument("source", choices=SOURCES)
    ingest.add_argument("--index-pages", required=True, help="Parquet (page_num, html)")
    ingest.add_argument("--article-pages", required=True, help="Parquet (url, html)")
    ingest.add_argument("--store", required=True)

    export = command("export-articles", "stored posts of one source to corpus and metadata")
    export.add_argument("source", choices=SOURCES)
    export.add_argument("--store", required=True)
    export.add_argument("--sample", action="store_true", help="write single texts of a random sample (default limit 200)")

    paper = command("process-papers", "paper files and metadata.csv to corpus and metadata")
    paper.add_argument("input_dir")
    paper.add_argument("--sample", action="store_true", help="write single texts of a random sample (default limit 200)")

    paper.add_argument("--single-line", action="store_true", help="no CSV field holds a line break: one file may be several tasks")

    post = command("process-posts", "labelled post tables to corpus and metadata")
    post.add_argument("inputs", nargs="+", metavar="LABEL=PATH")
    post.add_argument("--single-line", action="store_true", help="no CSV field holds a line break: one file may be several tasks")

    split = command("split-ids", "12-column id table to one folder per day", limited=False)
    split.add_argument("tsv")
    split.add_argument("--days", nargs=2, metavar=("FIRST", "LAST"))

    date = command("date-id-files", "date and new name of every id file", limited=False)
    date.add_argument("ids", nargs="+")
    date.add_argument("--archive", required=True)

    hydrate = command("hydrate-tweets", "tweet ids to corpus and metadata, batch by batch", limited=False)
    hydrate.add_argument("ids", nargs="+")
    hydrate.add_argument("--archive", required=True, help="tweet objects, one JSON per line")
    hydrate.add_argument("--countries", required=True, help="CSV ord,name,alpha2,alpha3")
    hydrate.add_argument("--ledger", required=True)
    hydrate.add_argument("--batch-size", type=int, default=tweets.BATCH_SIZE)
    hydrate.add_argument("--max-batches", type=int)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark, out = get_session(f"quillmill {args.command}"), args.output_dir
    if args.command == "ingest-articles":
        index, pages = readers.read_pages(spark, args.index_pages), readers.read_pages(spark, args.article_pages)
        rejected = articles.scrape_articles(spark, args.source, index, pages, args.store, args.limit)
        rejected.write.mode("overwrite").json(f"{out}/{args.source}/rejected")
    elif args.command == "export-articles" and args.sample:
        articles.export_sample(spark, args.source, args.store, out, args.limit or 200)
    elif args.command == "export-articles":
        articles.export_articles(spark, args.source, args.store, out, args.limit)
    elif args.command == "process-papers" and args.sample:
        papers.sample_papers(spark, args.input_dir, out, args.limit or 200)
    elif args.command == "process-papers":
        papers.process_papers(spark, args.input_dir, out, args.limit, not args.single_line)
    elif args.command == "process-posts":
        posts.process_posts(spark, dict(i.split("=", 1) for i in args.inputs), out, args.limit, multi_line=not args.single_line)
    elif args.command == "split-ids":
        days = tuple(args.days) if args.days else None
        counts = tweets.split_id_table_by_day(spark, args.tsv, f"{out}/days", days)
        counts.orderBy("date").write.mode("overwrite").option("header", True).csv(f"{out}/daily_counts")
    elif args.command == "date-id-files":
        dated = tweets.id_file_dates(spark, args.ids, args.archive)
        dated.write.mode("overwrite").option("header", True).csv(f"{out}/id_file_dates")
    else:
        countries = readers.read_countries(spark, args.countries)
        log = tweets.hydrate_batches(
            spark, args.ids, args.archive, countries, out, args.ledger, args.batch_size, args.max_batches
        )
        print(f"{log.count()} batches done")


if __name__ == "__main__":
    main()
