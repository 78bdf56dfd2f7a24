"""sluice.sources"""
