"""DataFrame -> DataFrame operators."""

from riskloom.operators import (  # noqa: F401
    behavior,
    calendar,
    cleaning,
    evaluation,
    missing,
    modeling,
    profiling,
    sampling,
    sketches,
    timeline,
)
