"""spark-submit driver for the paced event producer (arguments: see ``cartpulse.streaming.emit.main``)."""

from cartpulse.streaming.emit import main

if __name__ == "__main__":
    main()
