"""python -m lettermill verify INDEX"""

import sys

from lettermill.plans.publish import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
