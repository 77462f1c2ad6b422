"""DuckDB spellings of predicates and as-of slices, written apart from the Spark code."""

from __future__ import annotations

from modelwarden.demo import AS_OF, duck_keys, duck_sql

D = f"date '{AS_OF}'"
END = f"timestamp '{AS_OF} 23:59:59'"


def ins(values):
    return "(" + ",".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def low(x):
    return f"lower(trim(cast({x} as varchar), ' '))"


def blank(x):
    return f"({x} is null or {low(x)} in ('','null','none'))"


def art(x):
    return f"({x} is null or {low(x)} in ('','null','none','-','нет','n/a','na','$not_applicable$','отсутствует'))"


def placeholder(x):
    return (f"coalesce({low(x)} in ('-','нет','n/a','na','$not_applicable$','not_applicable','not applicable',"
            "'не применимо'), false)")


def norm(x):
    return f"lower(trim(replace(cast({x} as varchar), chr(160), ' ')))"


def filled(x):
    return (f"coalesce({norm(x)} not in ('','null','none','nan','-','[]','{{}}') and not "
            f"regexp_full_match({norm(x)}, '\\[(null|\"\"|[\\s,])*\\]'), false)")


NA = "('$not_applicable$','not applicable','не применимо','неприменимо','n/a','na')"


def required(x):
    return f"({filled(x)} and {norm(x)} <> 'отсутствует' and {norm(x)} not in {NA})"


def is_na(x):
    return f"coalesce({norm(x)} in {NA}, false)"


def truth(x):
    return f"coalesce({low(x)} in ('true','1','да','yes','y'), false)"


def falsehood(x):
    return f"coalesce({low(x)} in ('false','0','нет','no','n'), false)"


def clean(x):
    return f"case when {blank(x)} then '$NULL$' else regexp_replace(trim(cast({x} as varchar), ' '), '\\s+', ' ', 'g') end"


def dim(x):
    return f"coalesce(cast({x} as varchar), '$NULL$')"


def real(x):
    return f"coalesce(cast({x} as date) >= date '2000-01-01' and cast({x} as date) < date '2090-01-01', false)"


def like(x, pattern):
    return f"regexp_matches(upper(coalesce(cast({x} as varchar),'')), '{pattern}')"


def category(x):
    return f"coalesce(upper(trim(cast({x} as varchar))) in ('A','B','C','D','E'), false)"


LOCATION = (r"(?i)((https?|hdfs|s3a?|abfss?|wasbs?|file|dbfs)://[^\s<>]+|\\\\[^\s\\]+\\[^\s]+|(^|\s)/([^\s/]+/)+[^\s]*"
            r"|(^|\s)[a-z]:\\[^\s]+|\b[a-z_][a-z0-9_]*\.[a-z_][a-z0-9_]*(\.[a-z_][a-z0-9_]*)?\b)")


def location(x):
    return f"({filled(x)} and coalesce(regexp_matches(cast({x} as varchar), '{LOCATION}'), false))"


def has_value(x):
    return f"coalesce({low(x)} not in ('','null','none','nan','[]','{{}}'), false)"


def secs(x):
    return f"epoch(cast({x} as timestamp))"


def days(end, start):
    return f"(({secs(end)} - {secs(start)}) / 86400.0)"


def live(alias_key="ctl_action"):
    return f"coalesce(upper(trim({alias_key})) <> 'D', true)"


def current(name, order="start_dt desc, ctl_datechange desc nulls last"):
    """As-of slice: newest valid row per key, then drop deletions."""
    keys = ", ".join(duck_keys(name))
    if name in ("valid", "sample_data", "metric"):
        order += ", ctl_loading desc"
    return (
        f"select * exclude (rn_) from (select *, row_number() over (partition by {keys} order by {order}) rn_ "
        f"from ({duck_sql(name)}) a_ where start_dt <= {D} and end_dt >= {D}) b_ where rn_ = 1 and {live()}"
    )


def state(name, current_only=True):
    """Newest state per key, closed rows kept on request."""
    keys = ", ".join(duck_keys(name))
    order = "start_dt desc, ctl_datechange desc nulls last"
    if name in ("valid", "sample_data", "metric"):
        order += ", ctl_loading desc"
    end = f" and end_dt >= {D}" if current_only else ""
    return (
        f"select * exclude (rn_) from (select *, dense_rank() over (partition by {keys} order by {order}) rn_ "
        f"from ({duck_sql(name)}) a_ where start_dt <= {D}{end}) b_ where rn_ = 1 and {live()}"
    )


def bucket(expr):
    return f"(('0x' || substr(md5({expr}),1,8))::ubigint)"


def ctes(**parts):
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in parts.items()) + "\n"


def ts(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def plain(df):
    """Spark side: dates and timestamps as text, so that results compare without a time zone."""
    from pyspark.sql import functions as F

    kinds = dict(df.dtypes)
    return df.select(*[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kinds[c].startswith("timestamp")
        else F.col(c).cast("string").alias(c) if kinds[c] == "date" else F.col(c)
        for c in df.columns
    ])


def written(df):
    """Spark side: the frame as a table in the shared folder, so that its readers do not derive it again.

    What was shuffled for it is freed once it is written.
    """
    from modelwarden.sources.files import scratch_folder, shuffles_freed

    path = scratch_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
