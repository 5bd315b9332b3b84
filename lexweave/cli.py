"""Command line: ``python -m lexweave.cli name SMILES...``, ``queries``, ``run QUERY DIR [--out DIR]``,
``store generate|verify|hash``, ``sources SPEC DIR``, ``rules stats|search|get|deps|eval``.

Exit codes: 0 fine, 1 violations or an unsupported molecule, 2 wrong use.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] not in ("name", "queries", "run", "store", "sources", "rules", "-h", "--help"):
        argv.insert(0, "name")  # a bare molecule
    parser = argparse.ArgumentParser(prog="lexweave")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("name", help="name molecules")
    p.add_argument("smiles", nargs="+")
    p.add_argument("--explain", action="store_true")
    sub.add_parser("queries", help="list queries")
    p = sub.add_parser("run", help="run a query over a folder of tables")
    p.add_argument("query")
    p.add_argument("folder")
    p.add_argument("--out")
    p = sub.add_parser("store", help="sharded node stores")
    p.add_argument("action", choices=("generate", "verify", "hash"))
    p.add_argument("path")
    p.add_argument("--nodes", help="a table to generate from")
    p = sub.add_parser("sources", help="verify files against their specifications")
    p.add_argument("spec")
    p.add_argument("folder")
    p = sub.add_parser("rules", help="query a rule corpus (a JSON array)")
    p.add_argument("action", choices=("stats", "search", "get", "deps", "eval"))
    p.add_argument("corpus")
    p.add_argument("--query", default="")
    p.add_argument("--id", default="")
    p.add_argument("--fact", action="append", default=[])
    p.add_argument("--chapter")
    p.add_argument("--type")
    p.add_argument("--limit", type=int, default=20)
    p.add_argument("--depth", type=int, default=1)
    p.add_argument("--reverse", action="store_true")
    a = parser.parse_args(argv)
    if a.command == "name":
        from lexweave.chem.namer import name_smiles

        results = [name_smiles(s) for s in a.smiles]
        for r in results:
            if not a.explain:
                del r["trace"]
            print(json.dumps(r, ensure_ascii=False))
        return int(any(r["status"] != "success" for r in results))
    if a.command in ("store", "sources", "rules"):
        return _tables(a)
    from lexweave import catalog

    if a.command == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    if a.query not in catalog.QUERIES:
        print(f"no query {a.query}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    df = catalog.QUERIES[a.query](SparkSession.builder.getOrCreate(), a.folder)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(50, truncate=False)
    return 0


def _tables(a: argparse.Namespace) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from lexweave.operators import graph, rules
    from lexweave.sources import canonical, files

    spark = SparkSession.builder.getOrCreate()
    if a.command == "store":
        if a.action == "generate":
            if not a.nodes:
                print("store generate needs --nodes", file=sys.stderr)
                return 2
            canonical.write_store(spark.read.parquet(a.nodes), a.path)
        if a.action == "hash":
            canonical.manifest(canonical.read_store(spark, a.path)).orderBy("document_id").show(1000, truncate=False)
            return 0
        found = canonical.verify_store(spark, a.path)
    elif a.command == "sources":
        s = files.specs(spark, a.spec)
        found = files.spec_violations(s).unionByName(files.verify(s, files.digests(spark, a.folder)))
    else:
        r = rules.load_rules(spark, a.corpus)
        if a.action == "stats":
            out = rules.stats(r)
        elif a.action == "get":
            out = rules.export(rules.get(r, a.id))
        elif a.action == "search":
            out = rules.search(r, a.query, a.chapter, a.type, a.limit).select("rule_id", "title", "source_chapter", "rule_type")
        elif a.action == "deps":
            edges = r.select(F.col("rule_id").alias("source"), F.posexplode("depends_on").alias("k", "target"), "pos").withColumn("pos", F.col("pos") * 100_000 + F.col("k"))
            out = graph.dependencies(edges, a.id, a.depth, a.reverse)
        else:
            out = rules.ranked(rules.evaluate(r, a.fact, a.chapter, a.type), a.limit).select("rank", "rule_id", "title", "condition_score", "matched_conditions")
        for line in out.toJSON().collect():
            print(line)
        return 0
    rows = found.orderBy("code", "key").limit(50).collect()
    for v in rows:
        print(f"{v.code}\t{v.key}\t{v.detail}")
    return int(bool(rows))


if __name__ == "__main__":
    sys.exit(main())
