"""Named models of every layer. Importing this package fills the model catalog."""

# Declaration order is build order: each layer only reads the ones above it.
from lakevault.plans import bronze  # noqa: F401  isort: skip
from lakevault.plans import silver  # noqa: F401  isort: skip
from lakevault.plans import vault  # noqa: F401  isort: skip
from lakevault.plans import gold  # noqa: F401  isort: skip
from lakevault.plans import business  # noqa: F401  isort: skip
from lakevault.plans.catalog import MODELS, Model, Tables, Unhashed

__all__ = ["MODELS", "Model", "Tables", "Unhashed"]
