"""spark-submit entry: ``spark-submit submit_analytics.py --curated-base ...``"""

from payerlens.plans.analytics import main

if __name__ == "__main__":
    main()
