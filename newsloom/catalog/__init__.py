"""The registered queries over the test tables and their SQL counterparts."""

from newsloom.catalog.oracles import ORACLES as _ORACLES
from newsloom.catalog.queries import QUERIES as _QUERIES
from newsloom.catalog.state_oracles import STATE_ORACLES
from newsloom.catalog.state_queries import STATE_QUERIES

QUERIES = {**_QUERIES, **STATE_QUERIES}
ORACLES = {**_ORACLES, **STATE_ORACLES}
