"""Identity audit: users, groups, roles, keys, credential report
(J1-J4, U1, U2, A11, N5, N10, N12). Lookups that the reference performs
one API call per user become joins against pre-aggregated sides."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.text import is_true
from tidewater.functions.time import as_ts, elapsed_days
from tidewater.operators.aggregate import gather_chunks
from tidewater.session import materialised, sized_broadcast

# The credential report's root account name and the
# timestamp layout of its last-used column.
ROOT_ACCOUNT = "<root_account>"
REPORT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"


def enrich_users(users: DataFrame, profiles: DataFrame, keys: DataFrame,
                 user_col: str = "UserName", key_id_col: str = "AccessKeyId") -> DataFrame:
    """J1. Users with ``has_console`` (login profile exists), their access
    keys as a sorted list and ``n_keys`` (0 when none).

    Keys are aggregated per user first, so the join is 1:1 on the user.
    """
    prof = profiles.select(user_col).distinct().withColumn("has_console", F.lit(True))
    k = keys.groupBy(user_col).agg(F.array_sort(F.collect_list(key_id_col)).alias("access_keys"))
    out = (users.join(prof, on=user_col, how="left").join(k, on=user_col, how="left"))
    return out.withColumns({
        "has_console": F.coalesce(F.col("has_console"), F.lit(False)),
        "access_keys": F.coalesce(F.col("access_keys"), F.array().cast("array<string>")),
        "n_keys": F.coalesce(F.size("access_keys"), F.lit(0)),
    })


def enrich_roles(roles: DataFrame, policies: DataFrame, role_col: str = "RoleName",
                 fields: Sequence[str] = ("PolicyName", "PolicyArn")) -> DataFrame:
    """J2. Roles with their attached policies as a sorted list of structs
    (empty list when none)."""
    agg = policies.groupBy(role_col).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("policies"))
    out = roles.join(agg, on=role_col, how="left")
    empty = F.array().cast(agg.schema["policies"].dataType)
    return out.withColumn("policies", F.coalesce(F.col("policies"), empty))


def role_policy_chunks(roles: DataFrame, policies: DataFrame, role_col: str = "RoleName",
                       fields: Sequence[str] = ("PolicyName", "PolicyArn"), chunk: int = 1000) -> DataFrame:
    """J2 for roles with any number of policies: one row per role and ``chunk`` policies of its sorted list
    (one row with an empty list for a role that has none)."""
    lists = gather_chunks(policies, [role_col], fields, chunk, F.lit(1), out="policies", count_out="n_policies")
    out = roles.join(lists, on=role_col, how="left")
    return out.withColumns({"chunk": F.coalesce("chunk", F.lit(0)), "n_policies": F.coalesce("n_policies", F.lit(0)),
                            "policies": F.coalesce("policies", F.array().cast(lists.schema["policies"].dataType))})


def with_mfa(users: DataFrame, devices: DataFrame, user_col: str = "UserName") -> DataFrame:
    """J3. Users that have at least one device (semi join). Devices are
    reduced to distinct users first (partial aggregate), so a user with a
    huge device list does not skew the join."""
    return users.join(devices.select(user_col).distinct(), on=user_col, how="left_semi")


def without_mfa(users: DataFrame, devices: DataFrame, user_col: str = "UserName") -> DataFrame:
    """J3. Users that have no device (anti join on distinct users)."""
    return users.join(devices.select(user_col).distinct(), on=user_col, how="left_anti")


def group_policies(membership: DataFrame, group_policies_df: DataFrame,
                   user_col: str = "UserName", group_col: str = "GroupName",
                   policy_col: str = "PolicyName") -> DataFrame:
    """J4. user -> group -> policy with the lineage kept in ``via_group``."""
    return (membership.select(user_col, group_col)
            .join(group_policies_df.select(group_col, policy_col), on=group_col, how="inner")
            .select(user_col, policy_col, F.col(group_col).alias("via_group")))


def user_permissions(direct: DataFrame, via_group: DataFrame, user_col: str = "UserName",
                     policy_col: str = "PolicyName") -> DataFrame:
    """U1. Direct ∪ via-group policies with ``origin``; duplicates are kept,
    ``total`` is the number of policy rows of the user."""
    d = direct.select(user_col, policy_col).withColumns(
        {"origin": F.lit("direct"), "via_group": F.lit(None).cast("string")})
    g = via_group.select(user_col, policy_col, "via_group").withColumn("origin", F.lit("group"))
    u = d.unionByName(g)
    totals = materialised(u.groupBy(user_col).agg(F.count(F.lit(1)).alias("total")), "totals")
    return u.join(sized_broadcast(totals), on=user_col, how="inner")


def explode_csv_text(df: DataFrame, col: str, schema: str, sep: str = ",") -> DataFrame:
    """N10. A CSV document held in one value -> one row per data line.

    The first line is the header: each column of ``schema`` (a DDL string)
    is read from the place its name has there, NULL where it has none.
    Fields may be quoted, with doubled quotes inside; a record is a line.
    The text is split once and only lines travel on, each read from left to right."""
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    comma = re.escape(sep)
    field = f'{comma}("[^"]*+(?:""[^"]*+)*+"(?={comma}|$)|[^{comma}]*+)'

    def fields(line: Column) -> Column:
        found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(field), 1)
        bare = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.transform(found, lambda x: F.when(x.rlike('(?s)^".*"$') & (F.length(x) > 1), bare(x)).otherwise(x))

    lines = F.split(F.btrim(F.replace(F.col(col), F.lit("\r\n"), F.lit("\n")), F.lit(" \t\n\x0b\f\r")), "\n")
    others = [c for c in df.columns if c != col]
    docs = df.select(*others, lines.alias("_tw_lines")).select(
        *others, fields(F.col("_tw_lines")[0]).alias("_tw_head"), F.slice("_tw_lines", 2, F.size("_tw_lines")).alias("_tw_lines"))
    rows = docs.select(*others, "_tw_head", F.explode("_tw_lines").alias("_tw_line")).where("_tw_line <> ''")
    rows = rows.withColumn("_tw_vals", fields(F.col("_tw_line")))
    place = lambda name: F.array_position("_tw_head", name).cast("int")
    value = lambda f: F.when(place(f.name) > 0, F.try_element_at("_tw_vals", place(f.name))).try_cast(f.dataType)
    return rows.select(*others, *[F.when(value(f) == "", None).otherwise(value(f)).alias(f.name) if f.dataType.simpleString() == "string"
                                  else value(f).alias(f.name) for f in StructType.fromDDL(schema).fields])


def credential_findings(report: DataFrame, as_of=None, max_days: int = 90) -> DataFrame:
    """U2. All audit findings from a credential report in one pass.

    Kinds: ``mfa_inactive``; ``password_stale`` (enabled, last used more
    than ``max_days`` elapsed days before ``as_of``; unparsable dates are
    skipped); ``active_keys`` (with the count). The root account is
    skipped. One row per finding.
    """
    ref = F.current_timestamp() if as_of is None else as_ts(as_of)
    r = report.filter(F.coalesce(F.col("user") != F.lit(ROOT_ACCOUNT), F.lit(True)))
    last = F.try_to_timestamp(F.col("password_last_used"), F.lit(REPORT_TS_FORMAT))
    days = elapsed_days(last, ref)
    n_keys = is_true("access_key_1_active").cast("int") + is_true("access_key_2_active").cast("int")
    finding = lambda kind, cond, detail: F.when(cond, F.struct(F.lit(kind).alias("kind"), detail.alias("detail")))
    arr = F.array(
        finding("mfa_inactive", ~is_true("mfa_active"), F.lit(None).cast("bigint")),
        finding("password_stale", is_true("password_enabled") & (days > max_days), days.cast("bigint")),
        finding("active_keys", n_keys > 0, n_keys.cast("bigint")),
    )
    return r.select("user", F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_f")).select(
        "user", "_f.kind", "_f.detail")


def active_keys(report: DataFrame) -> DataFrame:
    """A11. Users with at least one active access key and how many."""
    n = is_true("access_key_1_active").cast("int") + is_true("access_key_2_active").cast("int")
    return (report.filter(F.coalesce(F.col("user") != F.lit(ROOT_ACCOUNT), F.lit(True)))
            .select("user", n.alias("active_keys")).filter(F.col("active_keys") > 0))


def _as_list(v: Column, typ: str = "string") -> Column:
    """Variant holding a list or a scalar -> array (scalar wrapped)."""
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", f"array<{typ}>")) \
            .when(v.isNotNull(), F.array(F.try_variant_get(v, "$", typ)))


def trust_principals(roles: DataFrame, doc_col: str = "trust_policy", role_col: str = "RoleName",
                     first: int = 3) -> DataFrame:
    """N5. Trust-policy principals per role and principal type.

    The policy document (JSON text or already-parsed) holds ``Statement``
    (list or single object) whose ``Principal`` is an object of type ->
    value, where a value is a string or a list. Output: role, type,
    ``principals`` (all, as a list) and ``shown`` = the first ``first``
    joined by ", ". A bare ``"*"`` principal (not an object) yields no row.
    """
    doc = F.try_parse_json(F.col(doc_col).cast("string"))
    stmts = F.coalesce(F.try_variant_get(doc, "$.Statement", "array<variant>"),
                       F.array(F.try_variant_get(doc, "$.Statement", "variant")))
    s = roles.select(role_col, F.explode_outer(stmts).alias("_st"))
    pr = F.try_variant_get(F.col("_st"), "$.Principal", "map<string, variant>")
    p = s.select(role_col, F.explode(pr).alias("type", "_val"))
    lst = _as_list(F.col("_val"))
    return p.select(role_col, "type", lst.alias("principals")).withColumn(
        "shown", F.array_join(F.slice("principals", 1, first), ", "))


def wildcard_statements(policies: DataFrame, doc_col: str = "document",
                        name_col: str = "PolicyName") -> DataFrame:
    """N12. Allow statements whose ``Action`` (string or list) contains ``*``."""
    doc = F.try_parse_json(F.col(doc_col).cast("string"))
    stmts = F.coalesce(F.try_variant_get(doc, "$.Statement", "array<variant>"),
                       F.array(F.try_variant_get(doc, "$.Statement", "variant")))
    s = policies.select(name_col, F.posexplode(stmts).alias("statement_no", "_st"))
    actions = _as_list(F.try_variant_get(F.col("_st"), "$.Action", "variant"))
    effect = F.try_variant_get(F.col("_st"), "$.Effect", "string")
    return (s.select(name_col, "statement_no", effect.alias("effect"), actions.alias("actions"))
            .filter((F.col("effect") == F.lit("Allow"))
                    & F.coalesce(F.exists("actions", lambda a: a == F.lit("*")), F.lit(False))))
