"""Running a stage over new files only."""
