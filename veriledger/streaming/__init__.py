"""The feeds as streams: landing, incremental runs, bounded duplicate removal."""
