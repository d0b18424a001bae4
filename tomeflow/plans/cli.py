"""Command line: each command is one operator over files, or the whole pipeline."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.functions.dates import epoch, year_range
from tomeflow.functions.names import index_names
from tomeflow.operators import authors, graph, index, interactions, kcore, works
from tomeflow.plans import pipeline
from tomeflow.plans.config import Config, load_config
from tomeflow.sources import amazon, bookcrossing, goodreads, marc, openlibrary
from tomeflow.sources.sinks import table_info, write_csv, write_gml, write_table, write_tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tomeflow", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *args: tuple, **more) -> None:
        p = sub.add_parser(name, **more)
        for flags, options in args:
            p.add_argument(*flags, **options)

    out = (("-o", "--output"), {"required": True})
    flag = {"action": "store_true"}
    command("scan-marc", out, (("--book-mode",), flag), (("-L", "--line-mode"), flag), (("files",), {"nargs": "+"}))
    command("filter-marc", out, (("-t", "--tag"), {"type": int}), (("-f", "--subfield"), {}), (("-T", "--trim"), flag), (("-L", "--lower"), flag), (("-n", "--rename"), {"default": "contents"}), (("input",), {}))
    command("index-names", out, (("input",), {}))
    command("collect-isbns", out, (("sources",), {"nargs": "+", "help": "NAME=PATH:COLUMN[,COLUMN]"}))
    command("link-isbn-ids", out, (("-R", "--record-id"), {"required": True}), (("-I", "--isbn-field"), {"action": "append", "required": True}), (("--all-isbns",), {"required": True}), (("input",), {}))
    command("cluster-books", out, (("--nodes",), {"required": True}), (("--edges",), {"required": True}))
    command("extract-graph", out, (("--graph",), {"required": True}), (("--edges",), {"required": True}), (("-c", "--cluster"), {"type": int, "action": "append", "required": True}))
    command("cluster-hash", out, (("input",), {}))
    command("extract-books", out, (("-n", "--namespace"), {"required": True}), (("--name",), {"default": "book_id"}), (("--join-file",), {}), (("--join-field",), {}), (("input",), {}))
    command("scan-ratings", out, (("--swap-id-columns",), flag), (("input",), {}))
    command("scan-reviews", out, (("input",), {}))
    command("scan-openlib", out, (("kind",), {"choices": ["authors", "works", "editions"]}), (("input",), {}))
    command("scan-goodreads", out, (("kind",), {"choices": ["books", "works", "authors", "genres", "interactions"]}), (("input",), {}))
    command("bx-extract", out, (("input",), {}))
    command("cluster-ratings", out, (("--clusters",), {"required": True}), (("--key",), {"default": "asin"}), (("--order",), {}), (("--actions",), flag), (("input",), {}))
    command(
        "kcore", out, (("-k", "--core"), {"type": int, "default": 5}), (("-U", "--user-k"), {"type": int}), (("-I", "--item-k"), {"type": int}),
        (("--year",), {"type": int}), (("--start-date",), {}), (("--end-date",), {}), (("--compat",), flag), (("input",), {}),
    )
    table = lambda name: ((f"--{name}",), {"required": True})
    command("extract-authors", out, (("--first",), flag), *map(table, ("clusters", "edition-isbn-ids", "edition-authors", "author-names")), (("--record-isbn-ids",), {}), (("--record-authors",), {}))
    command("extract-author-gender", out, *map(table, ("clusters", "cluster-authors", "name-index", "author-genders")))
    command("cluster-interactions", out, (("kind",), {"choices": ["ratings", "actions"]}), (("--native-works",), flag), (("--books",), {"required": True, "help": "book links, or book identifiers for native works"}), (("input",), {}))
    command("work-gender", out, table("genders"), (("--compat",), flag), (("input",), {}))
    command("bx-actions", out, table("clusters"), (("--ratings",), flag), (("input",), {}))
    command("integration-stats", (("root",), {}), (("--config",), {}))
    command("pq-info", (("-o", "--output"), {}), (("--check-length",), flag), (("file",), {}))
    command("run", (("root",), {}), (("--config",), {}), (("--state",), {"help": "file that keeps which stages are up to date"}), (("--stage",), {"action": "append", "default": []}))
    return top


def kcore_times(args) -> tuple[int | None, int | None]:
    from datetime import date

    if args.year:
        return year_range(args.year)
    day = lambda s: epoch(date.fromisoformat(s)) if s else None
    return day(args.start_date), day(args.end_date)


def main(argv: list[str] | None = None, spark=None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        from tomeflow.session import session

        spark = session("tomeflow")
    read = spark.read.parquet
    match args.command:
        case "scan-marc":
            records = marc.read_delimited(spark, args.files) if args.line_mode else marc.read_documents(spark, args.files)
            if args.book_mode:
                write_tables(marc.book_tables(records), args.output)
            else:
                write_table(marc.flat_fields(records), args.output)
        case "filter-marc":
            write_table(marc.filter_fields(read(args.input), args.tag, args.subfield, args.trim, args.lower, args.rename), args.output, dictionary=(args.rename,))
        case "index-names":
            write_table(index_names(read(args.input)), args.output)
            write_csv(read(args.output), args.output.removesuffix(".parquet") + ".csv.gz")
        case "collect-isbns":
            sources = {}
            for s in args.sources:
                name, _, rest = s.partition("=")
                path, _, columns = rest.rpartition(":")
                table = spark.read.csv(path, header=True) if path.endswith(".csv") else read(path)
                sources[name] = (table, columns.split(","))
            write_table(index.collect_ids(sources), args.output)
        case "link-isbn-ids":
            write_table(index.link_ids(read(args.input), args.record_id, args.isbn_field, read(args.all_isbns)), args.output)
        case "cluster-books":
            write_table(graph.cluster_graph(read(args.nodes), read(args.edges)), args.output)
        case "extract-graph":
            nodes, edges = graph.subgraph(read(args.graph), read(args.edges), args.cluster)
            write_gml(nodes.withColumn("node_type", ids.namespace_name(F.col("book_code"))), edges, args.output)
        case "cluster-hash":
            write_table(graph.cluster_hashes(read(args.input)), args.output)
        case "extract-books":
            extra = read(args.join_file) if args.join_file else None
            write_table(graph.extract_books(read(args.input), args.namespace, args.name, extra, args.join_field), args.output)
        case "scan-ratings":
            write_tables(amazon.rating_tables(amazon.read_ratings(spark, args.input, args.swap_id_columns)), args.output)
        case "scan-reviews":
            write_tables(amazon.review_tables(amazon.read_reviews(spark, args.input)), args.output)
        case "scan-openlib":
            tables = {"authors": openlibrary.author_tables, "works": openlibrary.work_tables, "editions": openlibrary.edition_tables}[args.kind]
            write_tables(tables(openlibrary.read_dump(spark, args.input)), args.output)
        case "scan-goodreads":
            schema = {"books": goodreads.BOOK, "works": goodreads.WORK, "authors": goodreads.AUTHOR, "genres": goodreads.GENRES, "interactions": goodreads.INTERACTION}[args.kind]
            rows = goodreads.read(spark, args.input, schema)
            one = {"works": goodreads.work_info, "authors": goodreads.author_info}
            many = {"books": goodreads.book_tables, "genres": goodreads.genre_tables, "interactions": goodreads.interaction_tables}
            write_tables(many[args.kind](rows) if args.kind in many else {args.kind[:-1] + "_info": one[args.kind](rows)}, args.output)
        case "bx-extract":
            write_csv(bookcrossing.read_ratings(spark, args.input), args.output, compressed=False)
        case "cluster-ratings":
            linked = interactions.link_items(read(args.input), read(args.clusters), args.key, "isbn")
            write_table((interactions.cluster_actions if args.actions else interactions.cluster_ratings)(linked, order=args.order), args.output)
        case "kcore":
            rows = kcore.time_range(read(args.input), *kcore_times(args))
            write_table(kcore.kcore(rows, args.user_k or args.core, args.item_k or args.core, compat=args.compat), args.output)
        case "extract-authors":
            parts = [authors.edition_authors(read(args.clusters), read(args.edition_isbn_ids), read(args.edition_authors), read(args.author_names), first_only=args.first)]
            if args.record_authors:
                parts.append(authors.catalogue_authors(read(args.clusters), read(args.record_isbn_ids), read(args.record_authors)))
            write_table(authors.cluster_authors(*parts), args.output)
        case "extract-author-gender":
            names = authors.name_table(read(args.name_index), read(args.author_genders))
            write_table(authors.cluster_genders(read(args.clusters), read(args.cluster_authors), names), args.output)
        case "cluster-interactions":
            write_table(pipeline.shelf_rows(read(args.input), read(args.books), args.kind, args.native_works), args.output)
        case "work-gender":
            write_table(works.work_genders(read(args.input), read(args.genders), args.compat), args.output)
        case "bx-actions":
            write_table(pipeline.swap_rows(spark.read.csv(args.input, header=True, schema="user int, isbn string, rating float"), read(args.clusters), args.ratings), args.output)
        case "integration-stats":
            pipeline.integration_stats(pipeline.Store(spark, args.root, load_config(args.config) if args.config else Config()))
        case "pq-info":
            text = json.dumps(table_info(spark, args.file, args.check_length), indent=2)
            if args.output:
                with open(args.output, "w") as f:
                    f.write(text + "\n")
            else:
                print(text)
        case "run":
            config = load_config(args.config) if args.config else Config()
            for name in pipeline.run(pipeline.Store(spark, args.root, config), tuple(args.stage), state_path=args.state):
                print(name)


if __name__ == "__main__":
    main()
