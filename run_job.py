"""Entry script for spark-submit; see seriesflow.jobs."""

from seriesflow.jobs import main

if __name__ == "__main__":
    main()
