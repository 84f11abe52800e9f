"""Request texts: key filters (OP-18), request URLs (OP-02) and masking (OP-09)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# FIXED VALUES: protocol path, datetime literal format, password mask.
SERVICE_PATH = "/odata/standard.odata/"
DATETIME_LITERAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
PASSWORD_MASK = "[Пароль]"
CREDENTIALS_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^:/@]*:)[^@/]*@"


def quote_text(value: Column) -> Column:
    """SQL-style quoted text: ``it's`` → ``'it''s'``."""
    return F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))


def key_term(name_src: str, engine: str, value: Column) -> Column:
    """``<name> eq <typed literal>`` for one key column."""
    if engine == "uuid":
        lit = F.concat(F.lit("guid"), quote_text(value))
    elif engine == "text":
        lit = quote_text(value)
    elif engine == "timestamp":
        lit = F.concat(F.lit("datetime"), quote_text(F.date_format(value, DATETIME_LITERAL_FORMAT)))
    else:
        lit = value.cast("string")
    return F.concat(F.lit(name_src + " eq "), lit)


def key_filter(terms: list[Column]) -> Column:
    return F.concat_ws(" and ", *terms)


def request_path(publication: str | Column, entity: str | Column, query: Column) -> Column:
    """Request URI with spaces escaped, as sent to the source."""
    pub = F.lit(publication) if isinstance(publication, str) else publication
    ent = F.lit(entity) if isinstance(entity, str) else entity
    return F.replace(F.concat(F.lit("/"), pub, F.lit(SERVICE_PATH), ent, F.lit("?"), query), F.lit(" "), F.lit("%20"))


def mask_credentials(url: Column) -> Column:
    """Hide the password part of ``scheme://user:password@host/...``."""
    return F.regexp_replace(url, CREDENTIALS_PATTERN, "$1" + PASSWORD_MASK + "@")
