"""The raw reader against a brute-force model of positional header skipping."""

import gzip
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from taxaspark import schemas
from taxaspark.sources.raw import scan_src

AB = schemas.MARKER_ABUNDANCE
TAG = schemas.DEFAULT_RUN_TAG

line = st.one_of(
    st.builds(lambda m, v: f"m{m}\t{v}", st.integers(0, 99), st.integers(-5, 50)),
    st.builds(lambda m: f"#m{m}\t1", st.integers(0, 9)),   # data that looks like a comment
    st.just(""),                                            # blank line
)
sample_file = st.tuples(st.lists(line, max_size=12), st.sampled_from(["\n", "\r\n"]), st.booleans())


def model(files, skip):
    """Rows expected from the files: drop the first ``skip`` lines by position, then blank lines."""
    out = []
    for sid, (lines, _, _) in files.items():
        for text in lines[skip:]:
            if text == "":
                continue
            m, v = text.split("\t")
            out.append((sid, m, float(v)))
    return sorted(out)


@pytest.mark.parametrize("mode", ["wholetext", "lines"])
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(sample_file, min_size=1, max_size=4))
def test_positional_skip_matches_model(spark, mode, specs):
    root = tempfile.mkdtemp(prefix="taxaspark-prop-")
    files = {}
    for i, (lines, eol, final_eol) in enumerate(specs):
        sid = f"s{i}"
        text = eol.join(lines) + (eol if final_eol and lines else "")
        p = os.path.join(root, TAG, sid, AB.path_tail)
        os.makedirs(os.path.dirname(p))
        with gzip.open(p, "wt", newline="") as f:
            f.write(text)
        files[sid] = (lines, eol, final_eol)
    got = sorted(tuple(r) for r in scan_src(spark, f"{root}/{TAG}", AB, mode=mode).collect())
    assert got == model(files, AB.skip_rows)
