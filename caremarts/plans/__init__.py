"""caremarts.plans"""
