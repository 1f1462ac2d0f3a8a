from .columns import date_from_parts, lockstep_unnest, snake_case

__all__ = ["date_from_parts", "lockstep_unnest", "snake_case"]
