"""Plans: datasets (DS1-8), epoch planning (META), KPI views, sinks and the job."""
