"""spark-submit driver for the daily segmentation, top-products and conversion jobs (arguments: see ``cartpulse.plans.daily.main``)."""

from cartpulse.plans.daily import main

if __name__ == "__main__":
    main()
