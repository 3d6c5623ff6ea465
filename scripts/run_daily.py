"""spark-submit launcher for the daily top-names job (see mentionscope.plans.daily)."""

import sys

from mentionscope.plans.daily import main

if __name__ == "__main__":
    main(sys.argv[1:])
