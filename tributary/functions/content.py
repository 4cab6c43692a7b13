"""Hashing, routing, decoding and signatures, all as built-in expressions."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def document_id(source_id: Column, external_id: Column) -> Column:
    """Deterministic id, so a rerun yields the same rows."""
    return F.sha2(F.concat_ws("|", source_id, external_id), 256)


def route_by_size(size_bytes: Column, threshold_kb: int = 256, blob_store: bool = True) -> Column:
    if not blob_store:
        return F.lit("inline")
    return F.when(size_bytes <= threshold_kb * 1024, F.lit("inline")).otherwise(F.lit("reference"))


def blob_key(tenant: Column, file_id: Column, blob_id: Column, name: Column) -> Column:
    ext = F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1))
    dotted = F.when(F.length(ext) > 0, F.concat(F.lit("."), ext)).otherwise(F.lit(""))
    return F.concat(F.concat_ws("/", tenant, file_id, blob_id), dotted)


def decode_base64(text: Column, by_path: bool = False) -> Column:
    """Base64 to UTF-8 text. What cannot be decoded stays as it is, or becomes '' when read by path."""
    # most texts decode once their line breaks are gone; only what doesn't loses all characters outside the alphabet, as lenient
    # decoders have it, because looking for them costs many times the decoding
    one_line = F.replace(F.replace(text, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit(""))
    strict = F.try_to_binary(one_line, F.lit("base64"))
    lenient = F.try_to_binary(F.regexp_replace(text, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    good = F.try_validate_utf8(F.coalesce(strict, lenient).cast("string"))
    return F.coalesce(good, F.lit("") if by_path else text)


def decode_text(raw: Column) -> Column:
    """UTF-8, else Latin-1, else ''."""
    as_text = raw.cast("string")
    latin = F.decode(raw, "ISO-8859-1")
    return F.coalesce(F.when(F.is_valid_utf8(as_text), as_text).otherwise(latin), F.lit(""))


def webhook_payload(body: Column) -> Column:
    """The body if it is JSON, else the body wrapped as raw_body."""
    parsed = F.try_parse_json(body)
    return F.when(parsed.isNotNull(), body).otherwise(F.to_json(F.struct(F.coalesce(body, F.lit("")).alias("raw_body"))))


def webhook_event_type(github: Column, gitlab: Column, payload: Column) -> Column:
    return F.coalesce(F.nullif(github, F.lit("")), F.nullif(gitlab, F.lit("")), F.get_json_object(payload, "$.event_type"))


def hmac_pads(secret: str) -> tuple[str, str]:
    """Inner and outer HMAC-SHA256 pads of a secret, as hex."""
    key = secret.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256(payload: Column, ipad: Column, opad: Column) -> Column:
    """Hex HMAC from hex pads, which may be literals or columns of a secrets table."""
    inner = F.sha2(F.concat(F.unhex(ipad), F.encode(payload, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(opad), F.unhex(inner)), 256)


def verify_signature(payload: Column, header: Column, secret: str) -> Column:
    ipad, opad = hmac_pads(secret)
    expected = F.concat(F.lit("sha256="), hmac_sha256(payload, F.lit(ipad), F.lit(opad)))
    return F.coalesce(header == expected, F.lit(False))


def verify_signature_by(payload: Column, header: Column, ipad: Column, opad: Column) -> Column:
    """The same with the pads of a secrets table; a row without a secret is not verified."""
    return F.coalesce(header == F.concat(F.lit("sha256="), hmac_sha256(payload, ipad, opad)), F.lit(False))


def verify_token(header: Column, token: str | Column) -> Column:
    return F.coalesce(header == token, F.lit(False))


def verify_by_provider(provider: Column, payload: Column, header: Column, ipad: Column, opad: Column, token: Column) -> Column:
    """The proof each provider gives: the token itself from GitLab, a signature of the payload from the others."""
    return F.when(provider == "gitlab", verify_token(header, token)).otherwise(verify_signature_by(payload, header, ipad, opad))


def request_key(**items: Column) -> Column:
    """MD5 over the request's items in name order."""
    return F.md5(F.to_json(F.struct(*[items[k].alias(k) for k in sorted(items)])))


def bloom_size(expected_items: int, false_positive_rate: float) -> tuple[int, int]:
    """Bits and hash functions of an optimal Bloom filter."""
    bits = math.ceil(-(expected_items * math.log(false_positive_rate)) / math.log(2) ** 2)
    if bits >= 2**31:
        raise ValueError("more than 2**31 bits would overflow the modular arithmetic; use exact dedup instead")
    return bits, math.ceil(bits / expected_items * math.log(2))


def _hex_mod(digest: Column, start: int, m: int, odd: bool = False) -> Column:
    """128-bit hex number modulo m, optionally made odd first. Eight hex digits at a time stay inside a long."""
    acc = F.lit(0).cast("long")
    for word in range(4):
        part = F.conv(F.substring(digest, start + 8 * word, 8), 16, 10).cast("long")
        if odd and word == 3:
            part = part.bitwiseOR(F.lit(1).cast("long"))
        acc = (acc * F.lit(2**32) + part) % F.lit(m)
    return acc


def bloom_positions(df: DataFrame, key: Column, bits: int, hashes: int, name: str) -> DataFrame:
    """One row per bit position of a key: double hashing over the two halves of its SHA-256.

    The digest and its halves are columns of their own, so they are computed once per key.
    """
    digest = F.col("_digest")
    halves = (
        df.withColumn("_digest", F.sha2(key, 256))
        .withColumns({"_h1": _hex_mod(digest, 1, bits), "_h2": _hex_mod(digest, 33, bits, odd=True)})
        .drop("_digest")
    )
    numbered = halves.withColumn("_i", F.explode(F.array(*[F.lit(i).cast("long") for i in range(hashes)])))
    return numbered.withColumn(name, (F.col("_h1") + F.col("_i") * F.col("_h2")) % F.lit(bits)).drop("_h1", "_h2", "_i")
