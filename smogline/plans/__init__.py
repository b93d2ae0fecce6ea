"""Named queries and their oracles. Importing the package registers them all."""

from . import registry  # noqa: F401
from . import q_enrich, q_analyses, q_state, q_catalog, q_misc, q_store, q_forms  # noqa: F401,E402
