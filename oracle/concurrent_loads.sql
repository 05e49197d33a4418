select * from ev
