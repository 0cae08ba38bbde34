import os

import pandas as pd

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("TESSERA_TEST_SF", SF_SMALL)


def normalise(df: pd.DataFrame, cols: list[str]) -> pd.DataFrame:
    """Order-free, null-normalised string form of a result (NaN / None / NA -> NULL)."""
    out = pd.DataFrame()
    for c in cols:
        vals = []
        for v in df[c].tolist():
            if v is None or v is pd.NA or (isinstance(v, float) and v != v):
                vals.append("NULL")
            elif isinstance(v, float):
                vals.append(repr(float(v)))
            else:
                vals.append(str(v))
        out[c] = vals
    return out.sort_values(cols).reset_index(drop=True)


def same_result(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    if sorted(a.columns) != sorted(b.columns) or len(a) != len(b):
        return False
    cols = sorted(a.columns)
    return normalise(a, cols).equals(normalise(b, cols))
