"""The reference list of aggregator sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names looked for in a post's source.
AGGREGATOR_SITES = (
    "adzuna", "aftercollege", "akhtaboot", "aljazeerajobs", "americasjobexchange", "babajob",
    "jobbank", "careerbuilder", "careerstructure", "coolavenues", "dice", "eluta", "employiq",
    "entertainmentcareers", "fins", "glassdoor", "gumtree", "hispanicbusiness", "hound", "iaeste",
    "igrad", "indeed", "insidetrak", "internships", "internshala", "ivyexec", "jobandtalent",
    "jobberman", "jobbi", "jobindex", "jobing", "jobs.ac.uk", "jobserve", "jobstreet", "jobtrak",
    "kijiji", "lawcrossing", "linkedin", "linkup", "moster", "myscience", "maukri", "navent",
    "neuvoo", "oodle", "peopleperhour", "proven", "reed.co.uk", "researchgate", "rndeer",
    "simplyhired", "smartmatch", "snagajob", "spotjobs", "studentgems", "swissnex", "talentzoo",
    "talentegg", "employmentguide", "theladders", "themuse", "timesjobs", "tolmol", "trovit",
    "tweetmyjobs", "uloop", "usajobs", "workopolis", "workpop", "ziprecruiter",
)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """One site per line."""
    return spark.read.text(path).select(F.trim("value").alias("site")).filter("site <> ''")
