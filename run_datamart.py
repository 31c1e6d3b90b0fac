"""Entry for spark-submit; ship the package with --py-files."""

from snapmart.__main__ import main

if __name__ == "__main__":
    main()
