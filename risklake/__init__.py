"""Credit-risk analytics of a loan book on Spark: raw text -> typed tables -> risk views."""
