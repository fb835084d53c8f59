from inboxlens import Connection, Options, build, read_sources


def build_from(spark, tables: dict, options: Options = Options(), name: str = "conn_a"):
    raw = read_sources(spark, [Connection(name, tables)], options)
    return build(raw, options)


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict()
            for r in df.collect()}


def metrics(row: dict, prefix: str = "", unsub: bool = True):
    names = ["sends", "opens", "clicks", "unique_opens", "unique_clicks"] + (["unsubscribes"] if unsub else [])
    return tuple(row[prefix + n] for n in names)
