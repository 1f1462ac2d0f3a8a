"""spark-submit entry point: ``spark-submit --py-files shelfspark.zip run_shelfspark.py build ...``."""

from shelfspark.__main__ import main

if __name__ == "__main__":
    main()
