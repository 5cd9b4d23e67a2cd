"""Registry of the contract queries and of the SQL they are checked against."""

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    """Register a query; ``sql`` is the equivalent text for the checking engine."""

    def wrap(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return wrap
