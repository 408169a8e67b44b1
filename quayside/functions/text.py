"""Text expressions used in reasons, lineage and redaction."""

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "REDACTED"
# Up to the value: the request object, its params object, and in it the key.
_ECHOED = r'("request"\s*:\s*\{[^{}]*"params"\s*:\s*\{[^{}]*"api_key"\s*:\s*)'


def quoted(text: Column) -> Column:
    """The text in single quotes, as rejection reasons show it."""
    return F.concat(F.lit("'"), text, F.lit("'"))


def shown(text: Column, kind: Column) -> Column:
    """How a JSON value appears in a reason, from its text and VARIANT schema."""
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit("None"))
        .when(kind == "STRING", quoted(text))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def redact(body: Column, secret: str | None) -> Column:
    """Blank the request key that a JSON page echoes, then every other copy of the secret.

    The key stands at request.params.api_key and may be of any kind; a field of that name among the
    data stays. Only where the key is laid out so that it is not met there are all fields of the name
    blanked, because a key must not leak.
    """
    value = r'("(?:[^"\\]|\\.)*"|[^\s,}\]"]+)'
    there = F.regexp_replace(body, _ECHOED + value, f'$1"{REDACTED}"')
    left = F.get_json_object(there, "$.request.params.api_key")
    everywhere = F.regexp_replace(body, r'("api_key"\s*:\s*)' + value, f'$1"{REDACTED}"')
    echoed = F.when(left.isNull() | (left == REDACTED), there).otherwise(everywhere)
    return F.replace(echoed, F.lit(secret), F.lit(REDACTED)) if secret else echoed
