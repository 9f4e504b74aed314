import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from newsloom.session import build_session

    session = build_session("newsloom-tests", cores=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


LONG_FR = (
    "Le gouvernement a annonce une nouvelle reforme economique pour les regions du nord et de la cote, "
    "avec un plan qui doit aider les familles et les entreprises dans les annees a venir."
)
LONG_EN = (
    "The government said on Monday that it is ready to work with the regions and that the plan was "
    "agreed by all of the parties in the talks, which are to be held in the capital."
)


def article(**over):
    base = {
        "article_id": "a1",
        "titre": "Un port ouvre ses quais de nuit",
        "url": "https://news.example.org/port-quais",
        "source": "hespress.com",
        "langue": "fr",
        "date_publication": "2025-04-26T10:00:00",
        "contenu": f"<p>{LONG_FR}</p>",
        "pays": "MA",
        "raw_source": "hespress_rss",
        "auteur": "A. Writer",
        "categorie": "Ports",
        "ingested_at": "2025-04-26T11:00:00",
        "arrival": "0001",
    }
    return {**base, **over}


RAW_SCHEMA = (
    "article_id string, titre string, url string, source string, langue string, date_publication string, "
    "contenu string, pays string, raw_source string, auteur string, categorie string, ingested_at string, arrival string"
)


def raw_frame(spark, rows):
    columns = [f.split()[0] for f in RAW_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], RAW_SCHEMA)


def run_ts():
    from pyspark.sql import functions as F

    return F.lit("2025-04-26 12:00:00").cast("timestamp")
