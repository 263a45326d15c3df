"""DuckDB SQL for the feature index of ``ml.feature.HashingTF``: standard
Murmur3 x86 32-bit of the UTF-8 bytes, seed 42, masked to 2^18 buckets
(used only by the oracle of the hashed pipelines)."""

# Murmur3 x86 32-bit constants and the HashingTF seed.
C1, C2, SEED = 0xCC9E2D51, 0x1B873593, 42
M = 0xFFFFFFFF


def _mul(a: str, c: int) -> str:
    return f"((CAST({a} AS HUGEINT) * {c}) & {M})"


def _rotl(a: str, r: int) -> str:
    return f"((({a} << {r}) | ({a} >> {32 - r})) & {M})"


def _byte(hx: str, pos: str) -> str:
    return f"CAST(('0x' || substr({hx}, {pos}, 2)) AS BIGINT)"


def index_sql(term: str, num_features: int = 1 << 18) -> str:
    hx = f"hex(encode({term}))"
    n = f"octet_length(encode({term}))"
    block = (f"({_byte(hx, '8 * i + 1')} | ({_byte(hx, '8 * i + 3')} << 8) | "
             f"({_byte(hx, '8 * i + 5')} << 16) | ({_byte(hx, '8 * i + 7')} << 24))")
    k = _mul(_rotl(_mul("k", C1), 15), C2)
    mix = f"((({_rotl(f'xor(h, {k})', 13)}) * 5 + 3864292196) & {M})"
    body = (f"list_reduce(list_transform(range(0, {n} // 4), lambda i: {block}), "
            f"lambda h, k: {mix}, CAST({SEED} AS HUGEINT))")
    # tail: 1-3 remaining bytes, little-endian
    t = f"({n} // 4) * 8"
    tail = (f"(CASE WHEN {n} % 4 >= 1 THEN {_byte(hx, f'{t} + 1')} ELSE 0 END"
            f" | CASE WHEN {n} % 4 >= 2 THEN {_byte(hx, f'{t} + 3')} << 8 ELSE 0 END"
            f" | CASE WHEN {n} % 4 >= 3 THEN {_byte(hx, f'{t} + 5')} << 16 ELSE 0 END)")
    kt = _mul(_rotl(_mul("tl", C1), 15), C2)
    h1 = f"(CASE WHEN {n} % 4 > 0 THEN xor(hb, {kt}) ELSE hb END)"
    h2 = f"xor({h1}, {n})"
    f1 = _mul(f"xor(x, x >> 16)", 0x85EBCA6B)
    f2 = _mul(f"xor(y, y >> 13)", 0xC2B2AE35)
    fin = f"xor(z, z >> 16)"
    # nested lets through single-element list transforms
    expr = (f"list_transform([{body}], lambda hb: list_transform([{tail}], lambda tl: "
            f"list_transform([{h2}], lambda x: list_transform([{f1}], lambda y: "
            f"list_transform([{f2}], lambda z: {fin})[1])[1])[1])[1])[1]")
    return f"CAST(({expr}) & {num_features - 1} AS INTEGER)"
