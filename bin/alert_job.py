"""spark-submit driver for the streaming alert job (arguments: see ``cartpulse.streaming.job.main``)."""

from cartpulse.streaming.job import main

if __name__ == "__main__":
    main()
