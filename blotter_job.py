"""Entry script of the batch job for ``spark-submit`` (see blotter/plans/job.py).

A script's own folder is on the path, so this file finds the package beside it
wherever it is started from; in cluster deploy mode add the package with
``--py-files blotter.zip``.
"""

import sys

from blotter.plans.job import main

if __name__ == "__main__":
    sys.exit(main())
