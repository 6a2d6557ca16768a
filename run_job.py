"""Launcher for spark-submit: ``spark-submit --py-files slipflow.zip run_job.py --registry .. --out ..``"""

from slipflow.plans.job import main

if __name__ == "__main__":
    main()
