from .tables import TABLES, read_table  # noqa: F401
from .views import (  # noqa: F401
    baskets, customers, inventory, products, transactions, events,
)
