"""Command line: ``python -m shelfspark build|land|replay ...``."""

from __future__ import annotations

import argparse
import json

from .session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser("shelfspark")
    sub = ap.add_subparsers(dest="command", required=True)
    land = sub.add_parser("land", help="derive documents from driver tables and land them as JSON")
    land.add_argument("--tables", required=True)
    land.add_argument("--out", required=True)
    b = sub.add_parser("build", help="landed run -> gated models, checks and mart export")
    b.add_argument("--landed", required=True)
    b.add_argument("--run-id", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--buckets", type=int, default=None)
    r = sub.add_parser("replay", help="drain a topic log from the start (bounded)")
    r.add_argument("--log", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--topics", nargs="*", default=None, help="extra topics, added to raw_user and raw_media")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.command == "land":
        from .sources import fixtures, landing
        from .session import scratch_path
        import uuid
        staging = scratch_path(spark, f"entry-facts-{uuid.uuid4().hex}")
        landing.land_json(fixtures.build_documents(spark, args.tables, staging_path=staging), args.out)
        print(json.dumps({"landed": args.out}))
    elif args.command == "build":
        from .plans.jobs import build
        print(json.dumps(build(spark, args.landed, args.run_id, args.out, buckets=args.buckets)))
    else:
        from .streaming import topics
        names = topics.DEFAULT_TOPICS + tuple(t for t in (args.topics or []) if t not in topics.DEFAULT_TOPICS)
        delivered = topics.replay_topic_log(spark, args.log, f"{args.out}/data", f"{args.out}/checkpoint", names)
        for row in topics.replay_counts(delivered).collect():  # one row per topic
            print(json.dumps(row.asDict()))
    spark.stop()


if __name__ == "__main__":
    main()
