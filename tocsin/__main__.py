"""Run the job from topic to topic: python -m tocsin [servers [input_topic [output_topic]]]."""

from __future__ import annotations

import argparse

from tocsin.schema import FIXED_DELAY, REQUESTED
from tocsin.session import build_session
from tocsin.sources.inputs import DEFAULT_INPUT_TOPIC, DEFAULT_SERVERS
from tocsin.sources.outputs import DEFAULT_OUTPUT_TOPIC
from tocsin.streaming.job import FORMS, KEYED, TRIGGER_INTERVAL, run_topic_job


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tocsin")
    parser.add_argument("servers", nargs="?", default=DEFAULT_SERVERS)
    parser.add_argument("input_topic", nargs="?", default=DEFAULT_INPUT_TOPIC)
    parser.add_argument("output_topic", nargs="?", default=DEFAULT_OUTPUT_TOPIC)
    parser.add_argument("--checkpoint", required=True, help="a folder all executors share")
    parser.add_argument("--policy", choices=[REQUESTED, FIXED_DELAY], default=REQUESTED)
    parser.add_argument("--form", choices=FORMS, default=KEYED, help="state by id, or whole micro-batches at once")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL, help="how often a micro-batch starts")
    parser.add_argument(
        "--source-option", action="append", default=[], metavar="KEY=VALUE", dest="source_options",
        help="an option of the topic reader, such as maxOffsetsPerTrigger=100000",
    )
    found = parser.parse_args(given)
    found.source_options = dict(option.split("=", 1) for option in found.source_options)
    return found


if __name__ == "__main__":
    spark = build_session()
    run_topic_job(spark, **vars(arguments()))
    spark.streams.awaitAnyTermination()
