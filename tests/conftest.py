import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapfacet.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="snapfacet-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="snapfacet-test-")


def raw_posting(**kw):
    """A raw snapshot record (all strings); absent keys stay absent."""
    base = {
        "job_id": "700001",
        "agency": "DEPT OF X",
        "posting_type": "External",
        "number_of_positions": "2",
        "business_title": "Data Analyst",
        "civil_service_title": "CITY RESEARCH SCIENTIST",
        "title_classification": "Competitive-1",
        "title_code_no": "21744",
        "level": "02",
        "job_category": "Health Legal Affairs",
        "career_level": "Entry-Level",
        "salary_range_from": "50000",
        "salary_range_to": "60000.5",
        "salary_frequency": "Annual",
        "full_time_part_time_indicator": "F",
        "work_location": "1 Centre St",
        "division_work_unit": "Research",
        "job_description": "Analyse data.   Write reports.",
        "minimum_qual_requirements": "1. A degree; or 2. experience",
        "residency_requirement": "City residency required",
        "posting_date": "2026-01-20T00:00:00.000",
        "post_until": "15-JAN-2026",
        "posting_updated": "2026-01-21T00:00:00.000",
        "process_date": "2026-01-26T00:00:00.000",
    }
    base.update(kw)
    return {k: v for k, v in base.items() if v is not ...}


def write_json_lines(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
