"""Command line of the warehouse and streaming jobs."""

from __future__ import annotations

import argparse

from coursemill.plans import detail, member, questions, sales, streams
from coursemill.session import build_session

JOBS = {
    "load-member": lambda s, a: detail.load_area(s, a.ods, a.root, "member"),
    "load-questions": lambda s, a: detail.load_area(s, a.ods, a.root, "questions"),
    "load-sales": lambda s, a: detail.load_area(s, a.ods, a.root, "sales"),
    "member-wide": lambda s, a: member.build_member_wide(s, a.root, a.dt),
    "member-history": lambda s, a: member.build_member_history(s, a.root, a.dt),
    "member-reports": lambda s, a: member.build_member_reports(s, a.root, a.dt),
    "question-wide": lambda s, a: questions.build_question_wide(s, a.root, a.dt),
    "answer-detail": lambda s, a: questions.build_answer_detail(s, a.root, a.dt),
    "question-reports": lambda s, a: questions.build_question_reports(s, a.root, a.dt),
    "sales-detail": lambda s, a: sales.build_sales_detail(s, a.root, a.dt, a.form),
    **{name: lambda s, a, name=name: streams.run(s, name, a.root, a.source, a.servers, a.once) for name in streams.STREAMS},
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="coursemill.plans")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="warehouse folder")
    parser.add_argument("--ods", help="folder of the raw logs")
    parser.add_argument("--dt", help="day as yyyyMMdd")
    parser.add_argument("--form", default="plain", choices=sorted(sales.FORMS))
    parser.add_argument("--source", help="of a stream: topic, or folder of text files")
    parser.add_argument("--servers", help="Kafka servers of the topic")
    parser.add_argument("--once", action="store_true", help="of a stream: take what is there and end")
    args = parser.parse_args()
    if args.job in streams.STREAMS and not args.source:
        parser.error("a stream needs --source")
    spark = build_session(f"coursemill-{args.job}")
    JOBS[args.job](spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
