"""The sample parties, from files to the cleansed table."""

import csv
import io

from entigrid.fixed_values import CLEANSED_FIELDS
from entigrid.operators.cleanse import normalize, rejects, with_notes
from entigrid.operators.duplicates import flag_duplicates
from entigrid.sources.party_files import read_parties
from fixtures import CLEANSED


def test_cleansed_table(spark, sample_dir):
    raw, files = read_parties(spark, sample_dir)
    assert files == 2
    cleansed = with_notes(flag_duplicates(normalize(raw))).select(CLEANSED_FIELDS)
    got = sorted([str(v) for v in row] for row in cleansed.collect())
    expected = sorted(list(csv.reader(io.StringIO(CLEANSED)))[1:])
    assert got == expected


def test_rejects(spark, sample_dir):
    raw, _ = read_parties(spark, sample_dir)
    assert [r.issue for r in rejects(raw).collect()] == ["P007: REJECTED — empty record"]
