import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from callcast.schema import CONTACT_SCHEMA  # noqa: E402
from callcast.session import build_session  # noqa: E402

# FIXTURES.md section 2: twelve hand-made contacts (contact_id = row number).
CONTACTS_SMALL = """\
age,job,marital,education,default,balance,housing,loan,contact,day,month,duration,campaign,pdays,previous,poutcome,y
25,student,single,secondary,no,500,no,no,cellular,5,may,300,1,-1,0,unknown,yes
29,services,single,secondary,no,-200,yes,yes,unknown,9,may,80,2,-1,0,unknown,no
30,management,married,tertiary,no,2500,yes,no,cellular,17,jul,210,1,180,2,success,yes
39,technician,married,secondary,no,0,yes,yes,cellular,18,aug,95,4,-1,0,unknown,no
40,blue-collar,married,primary,yes,-450,yes,yes,unknown,20,may,60,12,-1,0,unknown,no
49,management,divorced,tertiary,no,1200,no,no,telephone,28,jan,400,3,92,1,failure,no
50,services,married,unknown,no,800,yes,no,cellular,3,oct,520,2,300,5,other,yes
59,retired,divorced,primary,no,3100,no,no,cellular,11,oct,610,1,95,3,success,yes
60,retired,married,secondary,no,1500,no,no,telephone,30,dec,150,6,-1,0,unknown,no
61,retired,married,primary,no,4200,no,no,cellular,2,mar,230,1,-1,0,unknown,yes
35,unknown,single,unknown,no,750,no,no,unknown,14,jun,45,3,-1,0,unknown,no
44,blue-collar,married,primary,no,310,yes,no,unknown,21,may,130,2,-1,0,unknown,no
"""


@pytest.fixture(scope="session")
def spark():
    s = build_session("callcast-tests", cores=4, shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_csv(tmp_path_factory):
    d = tmp_path_factory.mktemp("small")
    p = d / "contacts_small.csv"
    p.write_text(CONTACTS_SMALL)
    return str(p)


@pytest.fixture(scope="session")
def small(spark):
    rows = []
    for i, line in enumerate(CONTACTS_SMALL.strip().splitlines()[1:], start=1):
        f = line.split(",")
        typed = [int(f[0]), *f[1:5], int(f[5]), *f[6:9], int(f[9]), f[10], *map(int, f[11:15]), f[15], f[16]]
        rows.append([i, *typed])
    return spark.createDataFrame(rows, CONTACT_SCHEMA)
