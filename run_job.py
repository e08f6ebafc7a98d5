"""Launcher for spark-submit: ``spark-submit --py-files inboxlens.zip run_job.py silver ...``."""

from inboxlens.apps import main

if __name__ == "__main__":
    main()
