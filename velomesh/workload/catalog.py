"""All registered queries."""

from velomesh.workload import feeds, network, star, streams, summaries  # noqa: F401
from velomesh.workload.registry import REGISTRY  # noqa: F401
