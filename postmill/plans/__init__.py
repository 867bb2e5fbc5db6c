"""The medallion jobs: ingest, silver, gold, reports and the whole build."""
