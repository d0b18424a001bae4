"""Column functions: text and identifier cleaning, names, dates, bit patterns, genders."""
