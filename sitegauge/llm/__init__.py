"""Operators for building training data: packing, classifiers, near duplicates, personal data, rules, mixing, licences."""
