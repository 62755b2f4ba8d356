"""DuckDB SQL fragments shared by the oracles (UTC, epoch microseconds)."""

US = 1_000_000
# the item id of an event
ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def ev(where: str = "TRUE") -> str:
    """Events with epoch-µs ``t`` and the parsed item id."""
    return f"SELECT *, epoch_us(ts) AS t, {ITEM} AS item_id FROM events WHERE {where}"


def sliding(src: str, size_s: int, slide_s: int, cols: str) -> str:
    """All windows ``[ws, ws+size)`` holding ``t``; adds ``ws`` (µs)."""
    k = -(-size_s // slide_s)
    sz, sl = size_s * US, slide_s * US
    return (f"SELECT {cols}, (t // {sl} - k) * {sl} AS ws FROM ({src}) s, range(0, {k}) r(k) "
            f"WHERE (t // {sl} - k) * {sl} + {sz} > t")
