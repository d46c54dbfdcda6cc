"""spark-submit refresh_tables.py kegg gene disease --landing … --target … --check"""

from codonmill.plans.refresh import main

if __name__ == "__main__":
    main()
