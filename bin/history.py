"""spark-submit driver for the history queries over the result tables (arguments: see ``cartpulse.plans.history.main``)."""

from cartpulse.plans.history import main

if __name__ == "__main__":
    main()
