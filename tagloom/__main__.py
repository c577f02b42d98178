from tagloom.jobs import main

main()
