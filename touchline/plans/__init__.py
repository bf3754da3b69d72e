"""Query recipes (the catalogue) over the season model.

Importing this package registers every recipe in
:data:`touchline.plans.registry.QUERIES` and its SQL oracle in
:data:`touchline.plans.registry.ORACLE`.
"""

from touchline.plans import raw, consolidated, compare, load, files  # noqa: F401,I001  (registration order)
from touchline.plans.model import Season, opened, season
from touchline.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "Season", "opened", "season"]
