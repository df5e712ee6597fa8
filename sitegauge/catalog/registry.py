"""Name -> Spark query and name -> checking SQL."""

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql.strip()
        return query

    return add
