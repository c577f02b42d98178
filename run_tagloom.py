"""Entry script for spark-submit."""

from tagloom.jobs import main

if __name__ == "__main__":
    main()
