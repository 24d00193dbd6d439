from gridstats.sources.readings import read_readings, register, split_readings

__all__ = ["read_readings", "register", "split_readings"]
