"""spark-submit entry: ``spark-submit submit_pipeline.py --input ... --output-base ...``"""

from payerlens.plans.pipeline import main

if __name__ == "__main__":
    main()
