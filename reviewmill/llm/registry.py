QUERIES, ORACLES = {}, {}


def query(sql=None):
    """Register the decorated function (spark, folder) -> DataFrame under its name, with its SQL if there is one."""
    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run
    return add
