"""Entry point for spark-submit: `spark-submit job.py <command> ...`."""

import sys

from tidemart.plans.jobs import main

if __name__ == "__main__":
    sys.exit(main())
