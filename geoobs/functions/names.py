"""Expressions on file names, column labels, keys and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .clean import ColumnLike, _c


def _group(col: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, i), F.lit(""))


def stem(path: ColumnLike) -> Column:
    """File name without folders and the last extension."""
    return F.regexp_replace(F.substring_index(_c(path), "/", -1), r"\.[^.]*$", "")


def freq_from_name(path: ColumnLike) -> Column:
    """Frequency token HH, HR, DD, WW, MM or YY between underscores, tried in that order."""
    s = F.upper(stem(path))
    return F.coalesce(
        *[F.when(F.contains(s, F.lit(f"_{code}_")), F.lit(code)) for code in S.FREQ_OFFSETS]
    )


def _from(tokens: Column, i: int) -> Column:
    """Tokens from the ``i``-th (from 0) on, put together again; NULL if there is none."""
    rest = F.array_join(F.slice(tokens, F.lit(i + 1), F.greatest(F.size(tokens) - i, F.lit(0))), "_")
    return F.when(rest != "", rest)


def _token(tokens: Column, i: int) -> Column:
    token = F.get(tokens, F.lit(i))
    return F.when(token != "", token)


def _only(text: Column, characters: str) -> Column:
    """Whether a text has one character at least and none but these."""
    return (text != "") & (F.translate(text, characters, "") == "")


_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"


def flux_tokens(path: ColumnLike) -> Column:
    """Tokens of a file name between underscores."""
    return F.split(stem(path), "_")


def parse_flux_name(path: ColumnLike) -> Column:
    """Struct of site, product, subset, freq, first and last year and version.

    A full name has the prefix, site, product, subset, frequency, years and version between
    underscores; an interim name the prefix, site and everything else as the product.
    """
    return parse_flux_tokens(flux_tokens(path))


def parse_flux_tokens(tokens: ColumnLike) -> Column:
    """What ``parse_flux_name`` reads, from the tokens of a name; a column of them is made once a row."""
    t = _c(tokens)
    prefix, release = F.upper(F.get(t, F.lit(0))), F.upper(F.get(t, F.lit(2)))
    years = F.split(F.get(t, F.lit(5)), "-")
    first, last = F.get(years, F.lit(0)), F.get(years, F.lit(1))
    full = (
        (prefix == S.FULL_PREFIX)
        & ((release == "FLUXNET2015") | F.startswith(release, F.lit("ICOS")))
        & _token(t, 1).isNotNull() & _token(t, 3).isNotNull() & _token(t, 4).isNotNull()
        & (F.size(years) == 2) & _only(first, _DIGITS) & _only(last, _DIGITS)
        & (F.length(first) == 4) & (F.length(last) == 4) & _from(t, 6).isNotNull()
    )
    short = (prefix == S.INTERIM_PREFIX) & _token(t, 1).isNotNull() & _from(t, 2).isNotNull()
    return F.struct(
        F.when(full | short, F.get(t, F.lit(1))).alias("site_id"),
        F.when(full, F.get(t, F.lit(2))).when(short, _from(t, 2)).alias("product"),
        F.when(full, F.get(t, F.lit(3))).alias("subset"),
        F.when(full, F.get(t, F.lit(4))).alias("freq"),
        F.when(full, first.try_cast("int")).alias("year_start"),
        F.when(full, last.try_cast("int")).alias("year_end"),
        F.when(full, _from(t, 6)).alias("version"),
    )


def is_member(base: ColumnLike) -> Column:
    """Whether a file name is that of a product member: prefix, site with a hyphen, product, level."""
    t = F.split(_c(base), "_")
    site = F.get(t, F.lit(1))
    hyphen = F.locate("-", F.substring(site, F.lit(2), F.length(site) - 2)) > 0
    known = [(p + e).upper() for p in S.MEMBER_PRODUCTS for e in S.MEMBER_ENDINGS]
    return F.coalesce(
        (F.upper(F.get(t, F.lit(0))) == S.INTERIM_PREFIX) & hyphen
        & F.upper(_from(t, 2)).isin(known), F.lit(False),
    )


def group_name(product: ColumnLike) -> Column:
    """Product text without its release suffix, as a lower-case identifier."""
    base = F.regexp_replace(_c(product), r"(?i)_(INTERIM|L[0-9]).*", "")
    clean = F.regexp_replace(F.regexp_replace(base, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.lower(clean), F.lit("")), F.lit("data"))


def product_priority(name: ColumnLike) -> Column:
    """Rank of the product token found in a name; lower wins."""
    s = F.upper(_c(name))
    hits = [F.when(F.contains(s, F.lit(tok)), F.lit(rank)) for tok, rank in S.PRODUCT_PRIORITY]
    return F.coalesce(*hits, F.lit(S.OTHER_PRIORITY))


def parse_gas_name(name: ColumnLike) -> Column:
    """Struct of gas, trigram, kind, dataset number, height and station id of a gas file.

    The name is five tokens between underscores; the last one, the selection, may end in a height.
    """
    s = _c(name)
    body = F.when(F.endswith(s, F.lit(".nc")), F.substring(s, F.lit(1), F.length(s) - 3))
    t = F.split(body, "_")
    gas, trigram, kind, number, selection = (F.get(t, F.lit(i)) for i in range(5))
    ending = F.substring_index(selection, "-", -1)
    before = F.length(selection) - F.length(ending) - 1
    metres = F.when(
        F.endswith(ending, F.lit("magl")) & (before > 0),
        F.substring(ending, F.lit(1), F.length(ending) - 4),
    )
    known = (
        (F.size(t) == 5) & gas.isin(S.GASES) & (F.length(trigram) == 3)
        & _only(trigram, _LETTERS) & _only(kind, _LETTERS + "-") & _only(number, _DIGITS)
        & _only(selection, _LETTERS + _DIGITS + "-")
    )
    given = lambda c: F.when(known, c)
    height = given(F.when(_only(metres, _DIGITS), metres.try_cast("int")))
    return F.struct(
        given(gas).alias("gas"), given(trigram).alias("trigram"), given(kind).alias("kind"),
        given(number.try_cast("int")).alias("dataset_num"), height.alias("height"),
        given(F.concat(F.upper(trigram), F.coalesce(height, F.lit(0)).cast("string")))
        .alias("station_id"),
    )


def deployment_id(path: ColumnLike) -> Column:
    return stem(path)


def platform_code(path: ColumnLike) -> Column:
    """Letters and digits before the eight-digit date of a cruise file."""
    return _group(stem(path), r"^([A-Za-z0-9]+?)[0-9]{8}", 1)


def unit_of_label(label: ColumnLike, catalogue_unit: ColumnLike | None = None) -> Column:
    """Catalogue unit, else the text in the first square brackets of the label."""
    found = F.nullif(F.trim(F.regexp_extract(_c(label), r"\[([^\]]+)\]", 1)), F.lit(""))
    if catalogue_unit is None:
        return found
    return F.coalesce(F.nullif(_c(catalogue_unit), F.lit("")), found)


def standard_name(quantity: ColumnLike, label: ColumnLike | None = None) -> Column:
    """Standard name of a quantity kind; '' when no phrase matches."""
    q = F.lower(F.coalesce(_c(quantity), F.lit("")))
    raw = F.lower(F.coalesce(_c(label), F.lit(""))) if label is not None else F.lit("")
    out = []
    for phrase, name in S.STANDARD_NAMES:
        hit = F.contains(q, F.lit(phrase))
        if name == "air_pressure":
            hit = hit | F.contains(raw, F.lit(phrase))
        out.append(F.when(hit, F.lit(name)))
    return F.coalesce(*out, F.lit(""))


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def split_variable(name: ColumnLike) -> tuple[Column, Column]:
    """(root, suffix): position indices dropped, root = longest known prefix, else everything."""
    base = F.regexp_replace(_c(name), r"(_\d+){1,3}$", "")
    known = F.array(*[F.lit(k) for k in S.VARIABLE_META])
    parts = F.split(base, "_")
    prefixes = F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
        lambda k: F.array_join(F.slice(parts, F.lit(1), k), "_"),
    )
    root = F.get(F.filter(prefixes, lambda p: F.array_contains(known, p)), 0)
    suffix = F.when(root.isNull(), "").otherwise(
        F.substring(base, F.length(root) + 2, F.length(base))
    )
    return F.coalesce(root, base), suffix


def describe_variable(name: ColumnLike) -> Column:
    """Struct of root, suffix, units, standard name and long name of a flux column."""
    name = _c(name)
    is_qc = F.endswith(name, F.lit("_QC")) | F.endswith(name, F.lit("_FLAG"))
    root, suffix = split_variable(name)
    q_root, q_suffix = split_variable(F.regexp_replace(name, "_(QC|FLAG)$", ""))
    meta = S.VARIABLE_META
    long_names = _literal_map({k: v[1] for k, v in meta.items()})
    units = _literal_map({k: v[2] for k, v in meta.items()})
    std = _literal_map({k: v[0] for k, v in meta.items() if v[0]})
    texts = _literal_map(S.SUFFIX_TEXT)

    def titled(text: Column) -> Column:
        # A letter after any non-letter is capitalised, so "T2M" becomes "T2M" and "CO2_X" "Co2 X".
        words = F.split(F.lower(F.replace(text, F.lit("_"), F.lit(" "))), "(?<=[^a-z])(?=[a-z])")
        return F.array_join(F.transform(words, F.initcap), "")

    def with_suffix(base: Column, suf: Column) -> Column:
        text = F.coalesce(F.try_element_at(texts, suf), F.replace(suf, F.lit("_"), F.lit(" ")))
        return F.when(suf == "", base).otherwise(F.concat(base, F.lit(" ("), text, F.lit(")")))

    plain = with_suffix(F.coalesce(F.try_element_at(long_names, root), titled(root)), suffix)
    qc_base = F.coalesce(
        F.try_element_at(long_names, q_root), titled(F.regexp_replace(name, "_(QC|FLAG)$", ""))
    )
    return F.struct(
        root.alias("root"),
        suffix.alias("suffix"),
        F.coalesce(F.try_element_at(units, root), F.lit("1")).alias("units"),
        F.when(suffix == "", F.try_element_at(std, root)).alias("standard_name"),
        F.when(is_qc, F.concat(F.lit("Quality Control Flag for "), with_suffix(qc_base, q_suffix)))
        .otherwise(plain)
        .alias("long_name"),
    )


def anonymise_ip(ip: ColumnLike) -> Column:
    """IPv4 cut to /24, IPv6 to /48."""
    ip = _c(ip)
    v6 = F.concat(F.array_join(F.slice(F.split(ip, ":"), 1, 3), ":"), F.lit("::/48"))
    v4 = F.concat(F.array_join(F.slice(F.split(ip, r"\."), 1, 3), "."), F.lit(".0/24"))
    return F.when(F.contains(ip, F.lit(":")), v6).otherwise(v4)


def array_path(key: ColumnLike) -> Column:
    """Group path and array name: the key without its trailing indices of digits and dots.

    When every component is numeric the first one remains.
    """
    return F.regexp_replace(_c(key), "(?:/[0-9.]+)+$", "")


def array_name(key: ColumnLike) -> Column:
    """Array a chunk key belongs to."""
    return F.substring_index(array_path(key), "/", -1)


def group_path(key: ColumnLike) -> Column:
    """Groups above the array; '' at the top."""
    path = array_path(key)
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def is_chunk_index(part: ColumnLike) -> Column:
    return F.regexp_like(_c(part), F.lit("^[0-9.]+$"))


def is_tracked(key: ColumnLike) -> Column:
    """False for metadata documents."""
    return ~F.substring_index(_c(key), "/", -1).isin(S.METADATA_KEYS)


def pid_url(pid: ColumnLike) -> Column:
    """Resolver address of a bare identifier; addresses and empty text are kept."""
    p = _c(pid)
    return F.when((p == "") | F.startswith(p, F.lit("http")), p).otherwise(
        F.concat(F.lit(S.HANDLE_RESOLVER), p)
    )


def zone_label(hours: ColumnLike) -> Column:
    """UTC+01:00 style label of a whole-hour offset."""
    h = _c(hours).cast("int")
    sign = F.when(h < 0, "-").otherwise("+")
    return F.concat(F.lit("UTC"), sign, F.lpad(F.abs(h).cast("string"), 2, "0"), F.lit(":00"))


def strip_tags(text: ColumnLike) -> Column:
    """Text without markup tags."""
    return F.regexp_replace(_c(text), "<[^>]+>", "")
