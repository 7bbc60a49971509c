"""Archive job for ``spark-submit``: take in what has landed, once or at an interval."""

from __future__ import annotations

import argparse
import logging
import time

from pyspark.sql import SparkSession

from palaver.archive import ArchiveConfig, Archiver
from palaver.session import configure


def main() -> None:
    parser = argparse.ArgumentParser(prog="palaver", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder with guilds, channels and messages")
    parser.add_argument("--root", required=True, help="folder of the archive, on shared storage")
    parser.add_argument("--poll-interval-secs", type=int, default=300)
    parser.add_argument("--once", action="store_true", help="stop after what has landed so far")
    parser.add_argument("--polled-pass", type=int, metavar="ID", help="one full pass over the landed files")
    parser.add_argument("--polled", action="store_true", help="take messages as polled: repeat passes over what has landed since")
    parser.add_argument("--input-bytes", type=int, default=0, help="bytes shuffled at once, for sizing")
    args = parser.parse_args()

    logging.basicConfig(level=logging.INFO)
    spark = configure(SparkSession.builder.appName("palaver"), args.input_bytes).getOrCreate()
    config = ArchiveConfig(args.landing, args.root, args.poll_interval_secs)
    archiver = Archiver(spark, config)
    if args.polled:
        archiver.run_polled_once() if args.once else archiver.poll_forever()
    elif args.once:
        archiver.run_once()
    elif args.polled_pass is not None:
        archiver.run_polled(args.polled_pass)
    else:
        running = archiver.run_forever()
        while True:  # a feed that fails is started again, the others go on
            time.sleep(args.poll_interval_secs)
            running = archiver.restarted(running)


if __name__ == "__main__":
    main()
