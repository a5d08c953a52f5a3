from tidemark.queries import features, learning, relational, streams  # noqa: F401
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
