"""Import every query module so the registry is complete."""

from opslog.plans import catalog_core  # noqa: F401
from opslog.plans import catalog_seq  # noqa: F401
from opslog.plans import catalog_io  # noqa: F401
from opslog.plans import catalog_schemas  # noqa: F401
from opslog.plans import catalog_report  # noqa: F401
from opslog.plans import catalog_notify  # noqa: F401
