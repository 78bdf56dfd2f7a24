"""sluice.plans"""
