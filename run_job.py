"""Launcher for spark-submit: `run_job.py <job> <source> <target> [as_of]`, see carelake/jobs.py."""

import sys

from carelake.jobs import main

if __name__ == "__main__":
    main(*sys.argv[1:])
