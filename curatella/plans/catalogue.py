"""The core's query modules; each has QUERIES and ORACLE."""

from curatella.plans import curation, problems, reference

MODULES = (problems, reference, curation)
