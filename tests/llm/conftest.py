"""One thread for the small matrices of the models: Spark's tasks already use all cores."""

import os

for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    os.environ.setdefault(name, "1")
